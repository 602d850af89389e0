import random

import pytest

WORDS = "the of and to in river stone cloud window garden letter music paper orange winter summer table light shadow silver engine planet forest bridge".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(("", "", "", "s", "ed", ",", ".")) for _ in range(n))


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else rng.choice(WORDS) + "x" for w in text.split(" "))


def corpus(seed=1, n=60):
    """Texts with exact and near copies, shared passages, repeats, nulls, empty, short and long ones."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice((3, 8, 30, 80, 200, 400))) for _ in range(n)]
    shared = prose(rng, 70)
    texts += [texts[5]] * 4 + [texts[9]] * 2
    texts += [edited(rng, texts[k % n], rng.choice((0.01, 0.03, 0.05, 0.08))) for k in range(40)]
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, 30) for _ in range(6)]
    texts += [None, "", "   \n\t", "one", "One  two\nthree", "one two three", "a b c d e", "A B\tC d e", "x" * 3000, "ab" * 700, "é " * 300, (prose(rng, 9) + "\n") * 40, prose(rng, 3000)]
    return texts


@pytest.fixture(scope="session")
def texts():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, ("en", "de", None)[i % 3], f"src{0 if i % 3 else i % 7}" if i % 11 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)


#: Columns named like operators' own, and one that repeats another but for its case.
CLASHES = ("n_words", "kept", "component_id", "digest", "row", "id", "hash", "copy", "rate", "n", "f", "classes", "labels", "start", "host", "path", "rule", "verdict", "payload", "sha1", "spans", "_mix_rate", "s", "k", "best_u", "best_verdict", "u", "_d_id", "m_id", "archive", "text_")


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


def as_rows(df, *names):
    return sorted((tuple(r[n] for n in names or df.columns) for r in df.collect()), key=repr)
