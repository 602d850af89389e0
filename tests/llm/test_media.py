import hashlib
import io
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakework.llm import media
from tests.llm.conftest import as_rows, with_clashes


def padded(text):
    data = (text or "").encode()
    n = max(1, -(-len(data) // 576)) * 576
    return data + b"\xff" * (n - len(data))


def test_digests_and_files(docs, texts):
    plain = {r.doc_id: r for r in media.media_digests(docs).collect()}
    full = {r.doc_id: r for r in media.with_media(docs).collect()}
    for i, t in enumerate(texts):
        payload, r = padded(t), plain[i]
        assert (r.n_bytes, r.payload_bytes) == (len((t or "").encode()), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        stored = bytes(full[i].media)
        with wave.open(io.BytesIO(stored)) as w:
            assert (w.getnchannels(), w.getsampwidth()) == (1, 1) and w.readframes(w.getnframes()) == payload
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        pairs = np.array([(f.frame, f.code) for f in full[i].fingerprint], "<i4")
        assert r.feature == f"{len(pairs)}:{hashlib.sha256(pairs.tobytes()).hexdigest()}"
    assert len({plain[i].feature for i, t in enumerate(texts) if t == texts[5]}) == 1


def test_peaks_equal_a_direct_transform():
    s, rng = media.Spectrum(block=3), np.random.default_rng(1)
    samples = rng.integers(0, 256, 576 * 9, dtype=np.uint8)
    samples[576 * 6 :] = 130
    edges = np.linspace(1, s.frame // 2 + 1, s.bands + 1).astype(int)
    window, n = np.hanning(s.frame), np.arange(s.frame)
    got, found = media.peak_bins(samples, s), 0
    for f, row in enumerate(got):
        x = (samples[f * s.hop : f * s.hop + s.frame].astype(float) - 128) * window
        power = [abs((x * np.exp(-2j * np.pi * k * n / s.frame)).sum()) for k in range(s.frame // 2 + 1)]
        for b, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            beside = lambda k: max(power[k - 1], power[k + 1] if k + 1 < len(power) else 0)
            sure = [k for k in range(lo, hi) if power[k] >= s.level + 0.02 and power[k] >= beside(k) + 0.02]
            if row[b]:
                found += 1
                assert power[row[b]] >= max([s.level, beside(row[b]), *(power[k] for k in sure)]) - 0.02
            else:
                assert not sure
    assert found > 30 and (got == 0).any()
    assert np.array_equal(got, media.peak_bins(samples, media.Spectrum()))


def test_silence_and_steady_levels_have_no_peaks():
    s = media.Spectrum()
    assert not media.fingerprint(np.full(576 * 8, 128, np.uint8), s)[0].size
    for level in (100, 120, 125):
        peaks = media.peak_bins(np.full(576 * 8, level, np.uint8), s)
        assert not peaks.any()


@pytest.mark.parametrize("wrong", [{"fan": 4}, {"fan": 0}, {"frame": 4096}, {"hop": 0}, {"bands": 0}, {"hop": 1000}])
def test_codes_have_room(wrong):
    with pytest.raises(ValueError, match="room"):
        media.Spectrum(**wrong)


def test_long_texts(spark):
    text = "".join(chr(97 + (i * i // 7) % 26) for i in range(1_500_000))
    df = spark.createDataFrame([(1, text), (2, "short"), (3, text)], "doc_id bigint, text string").coalesce(1)
    rows = {r.doc_id: r for r in media.media_digests(df).collect()}
    t, c = media.fingerprint(np.frombuffer(text.encode(), np.uint8), media.Spectrum())
    assert rows[1].n_pairs == rows[3].n_pairs == len(t) > 10_000 and rows[1].feature == rows[3].feature
    assert rows[1].feature.endswith(hashlib.sha256(np.stack([t, c], axis=1).astype("<i4").tobytes()).hexdigest())


def test_a_shift_keeps_codes():
    """The fingerprint is of the sound, not of where it starts: shifted by whole hops, pairs come back later."""
    rng, s = np.random.default_rng(2), media.Spectrum()
    sound = rng.integers(0, 256, s.hop * 40, dtype=np.uint8)
    t, c = media.fingerprint(sound, s)
    u, d = media.fingerprint(np.concatenate([np.full(s.hop * 5, 128, np.uint8), sound]), s)
    assert set(zip((t + 5).tolist(), c.tolist(), strict=True)) <= set(zip(u.tolist(), d.tolist(), strict=True))


def test_tones_are_found():
    s = media.Spectrum()
    t = np.arange(s.rate)
    for bin_ in (10, 100, 200):
        wave_ = (128 + 100 * np.sin(2 * np.pi * bin_ * t / s.frame)).astype(np.uint8)
        assert (media.peak_bins(wave_, s) == bin_).any(axis=1).all()


def test_edges(spark, docs):
    assert media.media_digests(docs.where("doc_id < 0")).count() == 0
    assert as_rows(media.media_digests(with_clashes(docs))) == as_rows(media.media_digests(docs))
    row = media.media_digests(spark.createDataFrame([(None, None)], "doc_id bigint, text string")).first()
    assert (row.doc_id, row.n_bytes, row.payload_bytes, row.n_pairs) == (None, 0, 576, 0)
    assert media.media_digests(docs.union(docs)).agg(F.count("feature")).first()[0] == 2 * docs.count()


def test_short_texts_have_fingerprints_of_their_own():
    s, rng = media.Spectrum(), np.random.default_rng(4)
    assert all(media._stored(("Some words of a text, " * 30)[:n], s)[2].size for n in (40, 100, 287, 288, 575, 576, 577))
    short = ["".join(rng.choice(list("abcdefghij klmno"), n)) for n in rng.integers(40, 577, 200)]
    assert len({media._stored(t, s)[3].tobytes() for t in short}) == len(set(short))
