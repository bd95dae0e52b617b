"""Quality rules judged by host; DataFrame functions only.

Each text is measured once. Failures of each rule are counted per host, and a host's failure rate is shrunk towards the other
hosts' by a beta prior whose two parameters are estimated from the rates of all hosts, so a host with few documents is hardly
judged by them. A host whose shrunk rate of some rule is too high is given up, with all its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import named, stage

#: Words of a window, and the fewest words a text must have.
WINDOW, LEAST_WORDS = 5, 10
#: A host is given up when it is expected to fail a rule more often than this.
HOST_LIMIT = 0.5
#: The weight of the prior, in documents: what its estimate is held between.
LIGHTEST, HEAVIEST = 2.0, 1000.0

_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"

#: Rules by name: SQL conditions on the measures. The first two also decide about a document by itself.
BASE_RULES = {"few_words": f"n_words < {LEAST_WORDS}", "repeats": "100 * n_repeat_words > 20 * n_words"}
RULES = {**BASE_RULES, "symbols": "10 * n_symbols > n_words", "dup_lines": "10 * n_dup_lines > 3 * n_lines"}


def host_of(url: Column) -> Column:
    """The host of a URL, lower-cased and without ``www.``; a value that is no URL is its own host."""
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")
    return F.coalesce(host, url)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, and only where it is needed."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: str, window: int) -> Column:
    """How many words of the array column lie in a window that the text holds twice or more.

    Windows are told apart by 64 bits. Texts without a repeated window, nearly all, need no sorting.
    """
    w = F.col(words)
    last = F.size(w) - window
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    def covered(at: Column) -> Column:
        """Words covered by the windows that begin at the given places, in order."""
        each = F.transform(at, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - x, F.lit(window))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda total, n: total + n)

    def repeated(s: Column) -> Column:
        """Places of the windows whose neighbour in order of hashes is equal."""
        hit = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def count(h: Column) -> Column:
        in_order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_bound(_bound(in_order, repeated), covered))

    return F.when(last < 0, F.lit(0).cast("long")).otherwise(_bound(hashes, count))


def measures(docs: DataFrame, text: str, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without ``text`` (not null), with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``."""
    rest = [c for c in docs.columns if c != text]
    t = F.col(text)
    plain = t
    for symbol in _SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)
    rows = docs.select(
        *rest,
        F.array_remove(F.split(t, _BLANK, -1), "").alias("words_"),
        lines.alias("lines_"),
        (F.char_length(t) - F.char_length(plain)).cast("long").alias("n_symbols"),
    )
    return rows.select(
        *rest,
        F.size("words_").cast("long").alias("n_words"),
        F.char_length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines_").cast("long").alias("n_lines"),
        (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("long").alias("n_dup_lines"),
        _repeat_words("words_", window).alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Prior:
    """A beta distribution of the hosts' rates: its mean, and its weight in documents."""

    mean: float
    weight: float

    def shrunk(self, failed: Column, n: Column) -> Column:
        return (failed + self.mean * self.weight) / (n + self.weight)


def fit_prior(hosts: int, rates: float, squares: float, parts: float) -> Prior:
    """By moments: from the number of hosts and the sums of their rates, squared rates, and 1/n.

    The spread of true rates is that of the observed ones less what counting alone makes of n documents. No spread beyond
    that, or less than two hosts: the heaviest prior.
    """
    if not hosts:
        return Prior(0.0, HEAVIEST)
    mean = rates / hosts
    around = mean * (1 - mean)
    spread = (squares - hosts * mean * mean) / (hosts - 1) - around * parts / hosts if hosts > 1 else 0.0
    weight = around / spread - 1 if spread > 0 else HEAVIEST
    return Prior(mean, min(max(weight, LIGHTEST), HEAVIEST))


def host_verdicts(measured: DataFrame, host: str = "host", rules: dict[str, str] = RULES, limit: float = HOST_LIMIT) -> DataFrame:
    """``host, n``, for each rule ``rate_<rule>`` (shrunk), and ``given_up``: some rate is above ``limit``. Null is no host.

    Counts are combined in the tasks before they are shuffled, so a host with a third of all rows is no burden. Sums of rates
    are exact (nine decimals), so reruns agree.
    """
    known = measured.where(named(host).isNotNull())
    counts = stage(known.groupBy(named(host).alias("host")).agg(F.count("*").alias("n"), *[F.count_if(F.expr(rule)).alias(f"failed_{name}") for name, rule in rules.items()]), "hosts")
    part = lambda x: F.round(x, 9).cast("decimal(18,9)")
    sums = [F.count("*").alias("hosts"), F.sum(part(1 / F.col("n"))).alias("parts")]
    for name in rules:
        rate = part(F.col(f"failed_{name}") / F.col("n"))
        sums += [F.sum(rate).alias(f"rates_{name}"), F.sum(rate * rate).alias(f"squares_{name}")]
    found = counts.agg(*sums).first()
    number = lambda x: float(x or 0)
    priors = {name: fit_prior(found.hosts, number(found[f"rates_{name}"]), number(found[f"squares_{name}"]), number(found.parts)) for name in rules}
    shrunk = [priors[name].shrunk(F.col(f"failed_{name}"), F.col("n")).alias(f"rate_{name}") for name in rules]
    rates = counts.select("host", "n", *shrunk)
    return rates.withColumn("given_up", F.greatest(F.lit(0.0), *[F.col(f"rate_{name}") for name in rules]) > limit)


def _base_failed() -> Column:
    return F.expr(" OR ".join(BASE_RULES.values()))


def rule_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every row.

    A row stays unless it fails a base rule itself or its host is given up. Words are separated by ASCII white space; a null
    or empty text has none and fails. A row with a null host is judged by itself only. Rows that repeat count as often as they
    are there, also in the host's rates. No rows: no rows.
    """
    rows = docs.select(named(doc_id).cast("long").alias("doc_id"), named(host).cast("string").alias("host"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    measured = stage(measures(rows, "text"), "measured")
    bad = stage(host_verdicts(measured, limit=limit).where("given_up").select(F.col("host").alias("bad_host")), "given_up")
    out = measured.join(bad, F.col("host") == F.col("bad_host"), "left").withColumn("base_failed", _base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("bad_host").isNull()).drop("host", "bad_host")


def drop_by_rules(docs: DataFrame, text: str = "text", host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs``, all columns, that ``rule_report`` keeps; texts stay where they are read."""
    whole = F.struct(*map(named, docs.columns)).alias("row_")
    rows = docs.select(whole, named(host).cast("string").alias("host"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"))
    bad = stage(host_verdicts(stage(measures(rows.drop("row_"), "text"), "measured"), limit=limit).where("given_up").select(F.col("host").alias("bad_host")), "given_up")
    good = measures(rows, "text").where(~_base_failed()).join(bad, F.col("host") == F.col("bad_host"), "left_anti")
    return good.select(*[F.col("row_")[c].alias(c) for c in docs.columns])
