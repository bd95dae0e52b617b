"""Nearest-text search against a plain double loop."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import fuzzy as op


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def score(a, b):
    longer = max(len(a), len(b))
    return 1.0 if longer == 0 else 1 - distance(a.lower(), b.lower()) / longer


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abAB") for _ in range(rng.randint(0, 7))) for _ in range(n)]


@pytest.fixture(params=[(op.BROADCAST_BYTES, 99), (0, 99), (0, -1)], ids=["broadcast", "shuffled", "segments"])
def both_ways(request, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_BYTES", request.param[0])
    monkeypatch.setattr(op, "FEW", request.param[1])
    monkeypatch.setattr(op, "BLOCK_ROWS", 4)


@pytest.mark.parametrize("threshold", [0.4, 0.75, 0.8])
def test_best_match(spark, both_ways, threshold):
    asked, known = words(40, 1) + [None], words(30, 2)
    inputs = spark.createDataFrame(list(enumerate(asked)), "id int, t string")
    candidates = spark.createDataFrame(list(enumerate(known)), "p int, v string")
    found = {r.id: (r.match, r.score) for r in op.fuzzy_match_join(inputs, "t", candidates, "v", "p", threshold).collect()}
    assert len(found) == len(asked)
    for i, text in enumerate(asked):
        best = (None, None)
        for v in known if text is not None else []:
            if score(text, v) > (best[1] or threshold):
                best = (v, score(text, v))
        assert found[i][0] == best[0], text
        assert found[i][1] == (pytest.approx(best[1]) if best[1] is not None else None)


def test_top_matches(spark, both_ways):
    asked, known = words(25, 3), words(40, 4)
    inputs = spark.createDataFrame(list(enumerate(asked)), "id int, t string")
    candidates = spark.createDataFrame(list(enumerate(known)), "p int, v string")
    rows = op.top_similar(inputs, "t", candidates, "v", "p", 0.5, 3).collect()
    for i, text in enumerate(asked):
        wanted = sorted(((-score(text, v), p) for p, v in enumerate(known) if score(text, v) >= 0.5))[:3]
        assert [r.position for r in sorted(rows, key=lambda r: r["rank"]) if r.id == i] == [p for _, p in wanted]


def test_suggestions(spark):
    dim = spark.createDataFrame([(1, "projects", ["proj"]), (2, "pipelines", None), (3, "sql", ["query"])], "k int, name string, aliases array<string>")
    typed = spark.createDataFrame([("projcts",), ("querry",), ("zzz",)], "t string")
    found = op.did_you_mean(typed, "t", dim, "k", "name", "aliases").filter(F.col("rank") == 1)
    assert {(r.t, r.suggestion) for r in found.collect()} == {("projcts", "projects"), ("querry", "sql")}


def test_threshold_must_be_positive(spark):
    df = spark.createDataFrame([(1, "a")], "p int, v string")
    with pytest.raises(ValueError):
        op.fuzzy_match_join(df, "v", df, "v", "p", 0)


def sentences(n, seed):
    """Texts of two to six words out of 300, each fifth much longer, with a common beginning on some."""
    rng = random.Random(seed)
    known = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    return [" ".join((["common start"] if i % 3 == 0 else []) + [rng.choice(known) for _ in range(30 if i % 25 == 0 else rng.randint(2, 6))]) for i in range(n)]


def misspelled(texts, seed, most):
    rng, out = random.Random(seed), []
    for text in texts:
        chars = list(text)
        for _ in range(rng.randint(1, most)):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], ["x"], [chars[at], "é"]])
        out.append("".join(chars))
    return out


@pytest.mark.parametrize("threshold", [0.75, 0.8, 0.9])
def test_segments_lose_no_match(spark, monkeypatch, threshold):
    monkeypatch.setattr(op, "FEW", -1)
    monkeypatch.setattr(op, "BLOCK_ROWS", 8)
    known = sentences(120, 1)
    asked = misspelled(known, 2, 6)
    inputs = spark.createDataFrame(list(enumerate(asked)), "id int, t string")
    candidates = spark.createDataFrame(list(enumerate(known)), "p int, v string")
    rows = op.top_similar(inputs, "t", candidates, "v", "p", threshold, 2).collect()
    for i, text in enumerate(asked):
        wanted = sorted((-score(text, v), p) for p, v in enumerate(known) if score(text, v) >= threshold)[:2]
        assert [(r.rank, r.position) for r in sorted(rows, key=lambda r: r["rank"]) if r.id == i] == [(n + 1, p) for n, (_, p) in enumerate(wanted)]


@pytest.mark.parametrize(("common", "share"), [("", 0.1), ("common start ", 1)])
def test_segments_meet_few_candidates(spark, common, share):
    rng = random.Random(3)
    plain = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randint(9, 19))) for _ in range(1500)]
    known = [(common if i % 3 == 0 else "") + t for i, t in enumerate(plain)]
    asked = spark.createDataFrame([(t,) for t in misspelled(known, 4, 2)[::4]], "text string")
    candidates = spark.createDataFrame(list(enumerate(known)), "p int, v string")
    blocks = op._pack(candidates, "v", "p", 1)
    met, wide = op._lookups(asked, blocks, 0.8)
    assert asked.filter(~op._few_edits(asked, 0.8)).count() == wide.count() == 0
    compared = met.agg(F.sum(F.size("items"))).head()[0]
    scanned = op._meetings(asked, blocks, 0.8).agg(F.sum(F.size("items"))).head()[0]
    assert compared < share * scanned


def test_texts_with_the_common_part_only_are_scanned(spark, monkeypatch):
    monkeypatch.setattr(op, "FEW", -1)
    monkeypatch.setattr(op, "BLOCK_ROWS", 8)
    known = [f"Customer#{i:05d}" for i in range(60)]
    asked = [f"Custmer#{i:05d}" for i in range(0, 90, 7)]
    inputs = spark.createDataFrame([(t,) for t in asked], "t string")
    candidates = spark.createDataFrame(list(enumerate(known)), "p int, v string")
    blocks = op._pack(candidates, "v", "p", 1)
    assert op._lookups(inputs.select(F.lower("t").alias("text")), blocks, 0.8)[1].count() == len(asked)
    found = {r.t: r.position for r in op.top_similar(inputs, "t", candidates, "v", "p", 0.8, 1).collect()}
    assert found == {t: min((-score(t, v), p) for p, v in enumerate(known))[1] for t in asked}


def test_remainders_settle_texts_that_share_most_characters(spark, monkeypatch):
    """Exact answers without a scan, for changed, lost and added characters; texts with too many remainders are left over."""
    rng = random.Random(5)
    known = [f"Customer#{i * 7 % 1000:06d}{'é' * (i % 3)}" for i in range(1000)]
    asked = ["Custmer#" + t[10:] for t in known[:400]] + misspelled(known, 6, 3) + ["Customer#" + "".join(rng.choice("0123456789") for _ in range(6)) for _ in range(300)]
    inputs = spark.createDataFrame([(t.lower(),) for t in asked], "text string").distinct()
    candidates = spark.createDataFrame([*enumerate(known), *enumerate(known[:50], 2000)], "p int, v string")
    blocks = op._pack(candidates, "v", "p", 2)
    for strict, limit in ((True, 1), (False, 2)):
        settled, left = op._by_remainders(inputs, blocks, 0.8, strict, limit)
        rest, found = {r.text for r in left.collect()}, {}
        for r in [r for part in settled for r in part.collect()]:
            found.setdefault(r.text, []).append((r["rank"], -r.back))
        assert not rest & set(found) and len(rest) < 0.4 * inputs.count()
        for text in random.Random(7).sample(sorted({t.lower() for t in asked} - rest), 120):
            scored = sorted((-score(text, v), p) for p, v in [*enumerate(known), *enumerate(known[:50], 2000)])
            wanted = [p for s, p in scored if (-s > 0.8 if strict else -s >= 0.8)][:limit]
            assert sorted(found.get(text, [])) == [(n + 1, p) for n, p in enumerate(wanted)], text
    monkeypatch.setattr(op, "MOST_VARIANTS", 1)
    settled, left = op._by_remainders(inputs, blocks, 0.8, True, 1)
    assert sum(part.count() for part in settled) + left.count() == inputs.count()
