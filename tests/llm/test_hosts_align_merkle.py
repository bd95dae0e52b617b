import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
from helpers import SMALL, documents, in_sql, nothing, rows, sample_texts
from pyspark.sql import functions as F

from millrace.llm import align, host_rules, merkle
from millrace.llm.queries import ORACLE_SQL, QUERIES

tokenizers = pytest.importorskip("public_tokenizers")
A, B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op11_host_rules", "op13_merkle"])
def test_queries_match_sql(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows(QUERIES[name](spark, SMALL)) == in_sql(ORACLE_SQL[name], documents=docs)


# Host rules


def brute_force_measures(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines), len(lines) - len(set(lines)), len(hit))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def test_measures_of_odd_rows(spark):
    given = [
        *sample_texts(),
        (100, "a b c d e a b c d e f"),
        (101, "a a a a a a a"),
        (102, "one two three four\nfive six\nfive six\n five six\n\n \nfive six"),
        (103, "    é # $ \x1c %\x0b&|<>*"),
        (104, " ".join(f"w{i % 997}" for i in range(5000))),
        (105, "a b c d"),
        (106, "a b c d e"),
        (107, "x b c d e y b c d e x b c d e"),
    ]
    found = host_rules.rule_report(documents(spark, given)).collect()
    expected = Counter((i, *brute_force_measures(t)) for i, t in given)
    assert Counter((r.doc_id, *(r[m] for m in MEASURES)) for r in found) == expected
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def hosts(spark):
    """Twenty good hosts, one bad with many documents, one with a single bad document, one without a name."""
    good, bad = " ".join(f"w{i}" for i in range(30)), "too short"
    given = [(f"good{h}", bad if i == 0 else good) for h in range(20) for i in range(20)]
    given += [("bad", bad)] * 45 + [("bad", good)] * 5 + [("single", bad)] + [("single2", good)] + [(None, bad), (None, good)]
    return spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(given)], "doc_id long, source string, text string")


def test_bad_hosts_are_given_up(spark):
    docs = hosts(spark)
    found = {r.doc_id: r for r in host_rules.rule_report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()}
    kept = Counter((r.source, r.kept) for r in found.values())
    assert kept["bad", True] == 0 and kept["bad", False] == 50
    assert all(kept[f"good{h}", True] == 19 for h in range(20))
    assert kept["single2", True] == 1 and kept[None, True] == 1
    out = host_rules.drop_by_rules(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {i for i, r in found.items() if r.kept}


def test_rates_are_shrunk_as_the_prior_says(spark):
    docs = hosts(spark)
    measured = host_rules.measures(docs.selectExpr("source AS host", "text"), "text")
    found = {r.host: r for r in host_rules.host_verdicts(measured).collect()}
    counts = defaultdict(lambda: [0, 0])
    for r in docs.where("source IS NOT NULL").collect():
        counts[r.source][0] += len(r.text.split()) < 10
        counts[r.source][1] += 1
    rates = [f / n for f, n in counts.values()]
    mean = sum(rates) / len(rates)
    spread = sum((x - mean) ** 2 for x in rates) / (len(rates) - 1) - mean * (1 - mean) * sum(1 / n for _, n in counts.values()) / len(rates)
    weight = min(max(mean * (1 - mean) / spread - 1 if spread > 0 else 1000, 2), 1000)
    for host, (f, n) in counts.items():
        assert found[host].rate_few_words == pytest.approx((f + mean * weight) / (n + weight), abs=1e-6)
        assert found[host].given_up == (found[host].rate_few_words > 0.5)
    assert found["single"].rate_few_words < found["bad"].rate_few_words < 0.9


def test_prior_without_spread_or_hosts():
    assert host_rules.fit_prior(0, 0, 0, 0).weight == host_rules.HEAVIEST
    assert host_rules.fit_prior(1, 0.3, 0.09, 0.1) == host_rules.Prior(0.3, host_rules.HEAVIEST)
    assert host_rules.fit_prior(4, 2.0, 2.0, 0.004).weight == host_rules.LIGHTEST  # rates 0, 0, 1, 1


def test_hosts_of_urls(spark):
    given = ["https://WWW.Example.org/a?b", "http://a.b.c:80/", "src7", "", None, "http://[bad"]
    df = spark.createDataFrame([(u,) for u in given], "u string")
    assert [r[0] for r in df.select(host_rules.host_of(df.u)).collect()] == ["example.org", "a.b.c", "src7", "", None, "http://[bad"]


def test_host_rules_of_nothing(spark):
    assert host_rules.rule_report(nothing(spark)).collect() == [] and host_rules.drop_by_rules(nothing(spark)).collect() == []


def test_host_rules_keep_all_columns(spark):
    docs = documents(spark)
    assert host_rules.drop_by_rules(docs).columns == docs.columns


# Alignment


def brute_force_alignment(given):
    """Straight from the two libraries and the definition."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    out = []
    for doc_id, text in given:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        x = [bytes(table[c] for c in first.id_to_token(i)) for i in a]
        y = [piece(i) for i in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x) != whole or b"".join(y) != whole:
            out.append((doc_id, [], [], []))
            continue
        ends = [list(accumulate(map(len, z))) for z in (x, y)]
        groups, i, j = [], 0, 0
        for e in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(e) + 1, ends[1].index(e) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        out.append((doc_id, a, b, groups))
    counts = Counter((g[-1], h[-1]) for _, _, _, groups in out for g, h in groups)
    best = defaultdict(int)
    for (_, h), n in counts.items():
        best[h] = max(best[h], n)
    found = []
    for doc_id, a, b, groups in out:
        links = [(g[-1], h[-1]) for g, h in groups]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha(text) if a else ""))
    return sorted(found, key=repr)


TRICKY = [
    (200, "<|endoftext|> and </s><s> are plain text"),
    (201, "naïve café 日本語 😀 ▁ underline"),
    (202, "naïve café 日本語 😀 Ώ"),
    (203, "  two  spaces\tand\ttabs\n\n\nlines  "),
    (204, "don't won't it's 12345 a1b2"),
    (205, "x" * 3000),
    (206, " "),
    (207, "\x00\x01 control \x7f"),
    (208, "\r\n"),
]


def as_tuples(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=repr)


def test_alignment_of_odd_rows(spark):
    given = [*[(i, t) for i, t in sample_texts() if i != 13], *TRICKY]
    found = as_tuples(align.alignment_report(documents(spark, given), A, B))
    assert found == brute_force_alignment(given)


def test_alignment_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert as_tuples(QUERIES["op12_align"](spark, SMALL)) == brute_force_alignment(given)


def test_groups_are_spans_of_the_same_bytes(spark):
    first, second = align.ByteLevel(open(A, encoding="utf-8").read()), align.Piecewise(open(B, "rb").read())
    texts = dict(TRICKY)
    for r in align.alignments(documents(spark, TRICKY), A, B).collect():
        i = j = 0
        for k, m in zip(r.a_ends, r.b_ends):
            assert b"".join(first.pieces[x] for x in r.a_ids[i:k]) == b"".join(second.pieces[x] for x in r.b_ids[j:m])
            i, j = k, m
        assert (i, j) == (len(r.a_ids), len(r.b_ids))
        assert not r.a_ids or b"".join(first.pieces[x] for x in r.a_ids).decode() == " " + texts[r.doc_id]


def test_ids_are_those_of_the_library():
    """Random texts of all planes, and of white space, letters and quotes in every order."""
    from tokenizers import Tokenizer

    first = align.ByteLevel(open(A, encoding="utf-8").read())
    assert first.ranked is not None
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    rng = random.Random(3)
    some = [" ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "\r\n", "a", "I'll", "é", "\u0301", "日本", "😀", "12", "...", "'S", "<|endoftext|>", "ﬁ"]
    texts = ["".join(rng.choices(some, k=12)) for _ in range(3000)]
    texts += ["".join(chr(c) for c in rng.choices([*range(0xD800), *range(0xE000, 0x110000, 9)], k=15)) for _ in range(3000)]
    assert first.encode(texts) == [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_common_ends():
    assert align.common_ends([2, 3, 1], [1, 1, 4]) == ([1, 3], [2, 3])
    assert align.common_ends([], []) == ([], [])


def written_plainly(a, b, ends_a, ends_b):
    """Groups as text, one string joined after the other."""
    x, y = list(map(str, a)), list(map(str, b))
    out, i, j = [], 0, 0
    for k, m in zip(ends_a, ends_b):
        out.append(",".join(x[i:k]) + "|" + ",".join(y[j:m]))
        i, j = k, m
    return ";".join(out).encode()


def test_groups_are_written_part_by_part(monkeypatch):
    """Whatever the length of a part is, the text and the checked bytes are the same, and no part is longer."""
    aligner = align.Aligner(align.ByteLevel(open(A, encoding="utf-8").read()), align.Piecewise(open(B, "rb").read()))
    texts = [t for _, t in TRICKY]
    whole = list(aligner.align(texts))
    for tokens in (1, 2, 7, 1 << 16):
        monkeypatch.setattr(align, "TOKENS", tokens)
        for text, one, other in zip(texts, whole, aligner.align(texts)):
            assert all((x == y).all() for x, y in zip(one, other))
            parts = list(aligner.groups(*other))
            assert b"".join(parts) == written_plainly(*(x.tolist() for x in other))
            assert all(p.count(b",") + p.count(b"|") + p.count(b";") <= tokens for p in parts)
            assert not len(other[0]) or aligner.spellings[0].of(other[0]) == aligner.spellings[1].of(other[1]) == (" " + text).encode()


def test_writing_groups_costs_less_than_joining_strings():
    """CPU seconds, the least of some runs each; the old form took as long as the joins do."""
    from time import process_time

    aligner = align.Aligner(align.ByteLevel(open(A, encoding="utf-8").read()), align.Piecewise(open(B, "rb").read()))
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdeilmnorstu", k=rng.randint(2, 9))) for _ in range(40_000))
    found = next(aligner.align([text]))
    lists = [list(map(int, x)) for x in found]

    def least(f):
        runs = []
        for _ in range(5):
            start = process_time()
            f()
            runs.append(process_time() - start)
        return min(runs)

    assert least(lambda: list(aligner.groups(*found))) < 0.5 * least(lambda: written_plainly(*lists))


def test_link_table_is_bounded_by_the_vocabularies():
    first, second = align.ByteLevel(open(A, encoding="utf-8").read()), align.Piecewise(open(B, "rb").read())
    assert align.most_pairs([b"ab", b"b", b"b"], [b"b", b"ab", b"xab"]) == 9  # each of three with b, ab and xab
    assert align.most_pairs(first.pieces, second.pieces) < 500_000


def test_alignment_of_nothing(spark):
    assert align.alignment_report(nothing(spark), A, B).collect() == [] and align.alignments(nothing(spark), A, B).collect() == []


# Merkle manifest


def brute_force_tree(leaves, fan=2):
    """The root, and of each leaf its siblings, level by level, each with the leaf's place among them."""
    proofs = [[] for _ in leaves]
    nodes = [(x, [i]) for i, x in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), fan):
            run = nodes[at : at + fan]
            for place, (_, below) in enumerate(run):
                for i in below:
                    proofs[i].append((place, [x for k, (x, _) in enumerate(run) if k != place]))
            above.append((sha("".join(x for x, _ in run)), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], proofs


def brute_force_manifest(given, fan=2):
    """``given``: dicts of the fields. Rows of what the query returns."""
    text = lambda d: "".join("-" if d[c] is None else f"{len(str(d[c]).encode())}:{d[c]}" for c in merkle.FIELDS)
    by_lang = defaultdict(list)
    for d in given:
        hit = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 and d["n_chars"] is not None
        claim = sha(text({**d, "n_chars": d["n_chars"] + 1})) if hit else sha(text(d))
        by_lang[d["lang"]].append((d["doc_id"], sha(text(d)), claim))
    trees = {}
    for lang, found in by_lang.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))
        trees[lang] = brute_force_tree([leaf for _, leaf, _ in found], fan)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    root, upper = brute_force_tree([trees[x][0] for x in order], fan)
    out = []
    for lang, rest in zip(order, upper):
        for (doc_id, leaf, claim), proof in zip(by_lang[lang], trees[lang][1]):
            node = claim
            for place, others in [*proof, *rest]:
                node = sha("".join([*others[:place], node, *others[place:]]))
            out.append((doc_id, leaf, trees[lang][0], root, sha("".join(x for _, others in [*proof, *rest] for x in others)), node, node == root))
    return sorted(out, key=repr)


def manifest_rows(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[c] for c in names) for r in merkle.verify(df).collect()), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, pos long, n long, leaf string"
def tampered():
    return {"n_chars": F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def odd_documents(n):
    langs = ["en", None, "de", "", "é", "Z", "en", "en"]
    given = [{"doc_id": i * 3 % 101 - 5, "source": f"s{i % 3}" if i % 4 else None, "lang": langs[i % 8], "n_chars": i if i % 5 else None, "text": "ü-" * (i % 6) if i % 7 else None} for i in range(n)]
    return given + ([{"doc_id": None, "source": None, "lang": None, "n_chars": None, "text": None}, dict(given[3]), dict(given[3])] if n > 3 else [])


@pytest.mark.parametrize(("n", "fan", "levels"), [(1, 2, 10), (2, 2, 10), (3, 2, 1), (100, 2, 10), (100, 2, 1), (100, 2, 2), (90, 3, 1), (90, 3, 2), (90, 5, 4)])
def test_manifest_matches_brute_force(spark, n, fan, levels):
    """Also with blocks so small that roots of blocks are appended over several levels."""
    given = odd_documents(n)
    docs = spark.createDataFrame([(*(d[c] for c in merkle.FIELDS), "x", 1, 2, "y") for d in given], SCHEMA).repartition(3)
    assert manifest_rows(merkle.manifest(docs, claims=tampered(), fan=fan, levels=levels)) == brute_force_manifest(given, fan)


def test_a_long_group_in_many_blocks(spark):
    docs = spark.range(700).selectExpr("id AS doc_id", "'s' AS source", "if(id % 9 = 0, 'b', 'a') AS lang", "id AS n_chars", "repeat('t', int(id % 50)) AS text")
    given = [r.asDict() for r in docs.collect()]
    assert manifest_rows(merkle.manifest(docs, claims=tampered(), levels=3)) == brute_force_manifest(given)


@pytest.mark.parametrize("n", [*range(1, 20), 64, 65])
def test_witnesses_grow_with_each_append(n):
    leaves = [sha(str(i)) for i in range(n)]
    tree = merkle.Appender(2, merkle.levels_of(n, 2))
    for x in leaves:
        tree.append(x)
    root, proofs = brute_force_tree(leaves)
    assert tree.close() == root
    for x, steps, proof in zip(leaves, tree.steps, proofs):
        assert merkle.fold(x, b"".join(steps)) == root and list(merkle.siblings(b"".join(steps))) == proof


def test_every_change_is_found(spark):
    docs = spark.createDataFrame([(1, "s", "en", 3, "abc"), (2, "s", "en", 3, "abd"), (3, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    for column in merkle.FIELDS:
        claims = {column: F.when(F.col("doc_id") == 2, F.lit(None)).otherwise(F.col(column))}
        found = {r.doc_id: r.verified for r in merkle.verify(merkle.manifest(docs, claims=claims)).collect()}
        assert found == {1: True, 2: False, 3: True}


def test_fields_cannot_be_shifted(spark):
    """Null, empty, and the same characters in another field are all different leaves."""
    given = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("1:a", "b"), (None, None), ("-", None)]
    df = spark.createDataFrame(given, "x string, y string")
    assert len({r[0] for r in df.select(merkle.leaf([df.x, df.y])).collect()}) == len(given)


def test_manifest_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(merkle.manifest(empty)).collect() == []
