import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from lakework.llm import turns
from tests.llm.conftest import as_rows, with_clashes

GRAMMAR = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, rs in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """The cheapest edits by uniform-cost search over (turns taken, initials so far up to their grammar's state)."""
    import heapq

    found, done, fault = [(0, "", 0, "", ())], set(), faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    while found:
        cost, audit, i, state, lines = heapq.heappop(found)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        push = lambda c, e, j, r, line: (state, r) in step and heapq.heappush(found, (cost + c, audit + e, j, step[state, r], (*lines, line)))  # noqa: B023, E731
        for role in ("user", "assistant"):
            push(2, "I", i, role[0], role + ":")
        if i < len(rows):
            heapq.heappush(found, (cost + 3, audit + "D", i + 1, state, lines))
            if fault[i] not in ("blank", "duplicate"):
                cut, (_, role, text) = fault[i] == "truncated", rows[i]
                push(cut, "K", i + 1, role[:1], f"{role}:{text}")
                for other in ("user", "assistant"):
                    push(2 + cut, "R", i + 1, other[0], f"{other}:{text}")


def brute(rows):
    out = []
    for conv, rs in damage(rows).items():
        known = [t for t, _, _ in rs if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rs, rs[1:], strict=False)]
        cost, audit, text = cheapest(rs)
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out.append((conv, gaps, *(faults(rs).count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def sample(seed, n=120, most=9):
    rng = random.Random(seed)
    role = lambda: rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "u", "User", "", None))
    text = lambda: rng.choice(("Yes.", "No!", "and so", " ", "\n\t", "", None, "é? ", "x.\x85", "why?\n", "\x1c", f"number {rng.random()}."))
    return [(c, rng.choice((None, *range(12))), role(), text()) for c in range(n) for _ in range(rng.randint(1, most))]


def found(rows, **options):
    return as_rows(turns.repair(turns.damaged(rows), **options), *NAMES)


@pytest.mark.parametrize("options", [{}, {"segment": 2}, {"batch_rows": 3, "segment": 3}, {"long_turns": 0, "segment": 4, "batch_chars": 10}])
def test_equals_brute_force(spark, options):
    """Also where conversations go on over segments and batches, and where repeats are found by an aggregation."""
    rows = sample(4) + [(500, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(40)] + [(None, i % 7, "user", "nobody's?") for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, **options) == brute(rows)


def test_edits_give_the_grammar_and_their_cost(spark):
    df = spark.createDataFrame(sample(9), SCHEMA)
    damaged = turns.damaged(df)
    results = turns.repair(damaged)
    repaired = defaultdict(list)
    for r in turns.repaired_turns(damaged, results).collect():
        repaired[r.conv_id].append((r.place, r.role, r.text, r.edit))
    for r in results.collect():
        lines = sorted(repaired[r.conv_id])
        assert [x[0] for x in lines] == list(range(len(lines))) and GRAMMAR.fullmatch("".join(x[1][0] for x in lines))
        assert hashlib.sha256("\n".join(f"{x[1]}:{x[2]}" for x in lines).encode()).hexdigest() == r.repaired_sha256
        assert "".join(x[3] for x in lines) == r.audit.replace("D", "")


def test_edges(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "lost"), (7, None, None, None), (8, 3, "system", "only."), (9, 1, "user", "x" * 400_000), (9, 2, "assistant", "y" * 300_000 + ".")]
    rows += [(9, 2, "assistant", "y" * 300_000 + ".")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found(df)
    assert found(df.limit(0)) == []
    assert found(with_clashes(df).withColumn("long", df.text).withColumn("later", df.text).withColumn("gone", df.text)) == brute(rows)
    assert found(df.withColumn("conv_id", df.conv_id.cast("string"))) == sorted(((None if r[0] is None else str(r[0]), *r[1:]) for r in brute(rows)), key=repr)


@pytest.mark.parametrize("long_turns", [200, 10_000])
def test_one_conversation_with_nine_tenths_of_the_turns(spark, long_turns):
    rng = random.Random(6)
    rows = [(1, t // 2, rng.choice(("user", "assistant")), rng.choice(("hot.", f"said {rng.randint(0, 400)}", "end?", ""))) for t in range(1500)]
    rows += [(2 + i, t, ("user", "assistant")[t], f"cold {i}.") for i in range(80) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(df, long_turns=long_turns, batch_rows=400) == brute(rows)


def test_solver_keeps_least_costs_and_least_edits():
    rng = random.Random(2)
    solver = turns.Solver()
    texts = {"o": "tool", "s": "system", "u": "user", "a": "assistant"}
    for _ in range(20):
        codes = "".join(rng.choice("xsuaoSUAO") for _ in range(rng.randint(0, 7)))
        rows = [(i, texts.get(c.lower(), "user"), "" if c == "x" else f"{i}" if c.isupper() else f"{i}.") for i, c in enumerate(codes)]
        ends = [(cost, audit) for state, cost, audit in solver.solve({(codes, -1)})[codes, -1] if state in turns.ENDS]
        assert min(ends) == cheapest(rows)[:2]
