"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

Everything is a column expression: matches are cut out of the text by
splitting at marks, positions are running sums of the pieces' lengths. The
models are bigram counts of labelled samples (values that the patterns find,
and plain words), gathered by group-by over an alphabet of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderspark.llm.common import bounded_sample, spare
from larderspark.session import cut_lineage

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs are maximal, so a lower bound inside the pattern drops the same matches
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z][A-Za-z_-]{3,}"
LEAST_VALUE = 6
#: Characters that the models know; all candidates consist of them.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Documents with a secret that random strings, and documents that identifiers are learned from, at most (by hash).
RANDOM_ROWS, IDENTIFIER_ROWS = 20_000, 2_000
#: Pairs that a character's share counts like, in the probability of what follows another.
BACK_OFF = 5
#: Mean log-likelihood ratio per character pair from which a candidate is reported.
THRESHOLD = 0.5
MARK = "\u0001"


def clean(text: Column) -> Column:
    """Null is empty; the mark itself becomes another control character of the same length."""
    return F.translate(F.coalesce(text, F.lit("")), MARK, "\u0002")


def matches(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """Array of (start, kind, end) of the kept leftmost matches, in code points, end exclusive."""
    parts = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK)
    none = F.expr("cast(array() as array<struct<start: bigint, kind: int, end: bigint>>)")

    def step(held: Column, part: Column) -> Column:
        end = held["at"] + F.length(part)
        span = F.struct(held["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(
            end.alias("at"), (~held["inside"]).alias("inside"),
            F.when(held["inside"] & keep(part), F.concat(held["found"], F.array(span))).otherwise(held["found"]).alias("found"),
        )

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(False).alias("inside"), none.alias("found"))
    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda held: held["found"])).otherwise(none)


def value_of(match: Column) -> Column:
    return F.regexp_extract(match, ASSIGN, 1)


def base_spans(text: Column) -> list[Column]:
    every = lambda m: F.lit(True)
    return [
        matches(text, ASSIGN, 0, lambda m: F.length(value_of(m)) >= LEAST_VALUE),
        matches(text, ACCESS, 1, every),
        matches(text, HEX, 2, every),
    ]


def pair_counts(strings: DataFrame) -> DataFrame:
    """(a, b, n): how often character number b follows number a in column ``s``; numbers from 1, others left out."""
    numbers = strings.select(F.transform(F.split("s", ""), lambda c: F.instr(F.lit(ALPHABET), c)).alias("at"))
    pairs = numbers.select(F.explode(F.arrays_zip(
        F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))).alias("a"),
        F.slice("at", 2, F.greatest(F.size("at") - 1, F.lit(0))).alias("b"),
    )).alias("p"))
    return pairs.select("p.a", "p.b").filter("a > 0 and b > 0").groupBy("a", "b").agg(F.count("*").alias("n"))


def fit_model(docs: DataFrame, text: str = "text") -> list[float] | None:
    """Log-likelihood ratios random : identifier of all character pairs, row by row; None without samples.

    Random strings are the values that the fixed patterns find: the sample is
    drawn from the documents that have some, so however rare they are, they
    are learned from. Identifiers are the plain words of other documents. At most alphabet-squared counts of
    each reach the driver.
    """
    texts = docs.select(clean(F.col(text)).alias("t"))
    hits = cut_lineage(texts.filter(F.col("t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")), "hits")  # texts are searched once for them
    hit = bounded_sample(hits, RANDOM_ROWS, "t")
    found = lambda pattern, group: F.regexp_extract_all("t", F.lit(f"({pattern})"), F.lit(group))
    random = hit.select(F.explode(F.concat(found(ASSIGN, 2), found(ACCESS, 1), found(HEX, 1))).alias("s"))
    random = random.filter(F.length("s") >= LEAST_VALUE)
    plain = bounded_sample(texts, IDENTIFIER_ROWS, "t").select(F.explode(found(IDENTIFIER, 1)).alias("s"))
    size = len(ALPHABET)

    def logs(strings: DataFrame) -> list[float] | None:
        rows = pair_counts(strings).collect()
        counts = [[0] * size for _ in range(size)]
        for r in rows:
            counts[r["a"] - 1][r["b"] - 1] = r["n"]
        whole = sum(map(sum, counts))
        share = [(sum(row[b] for row in counts) + 0.5) / (whole + 0.5 * size) for b in range(size)]
        # pairs back off to the second character's share
        return [
            math.log((n + BACK_OFF * share[b]) / (sum(row) + BACK_OFF)) for row in counts for b, n in enumerate(row)
        ] if rows else None

    one, other = logs(random), logs(plain)
    return [x - y for x, y in zip(one, other)] if one and other else None


def ratio(string: Column, model: list[float]) -> Column:
    """Mean log-likelihood ratio over the character pairs of a string over the alphabet."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    at = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(
        F.slice(at, 1, F.length(string) - 1), F.slice(at, 2, F.length(string) - 1),
        lambda a, b: F.get(table, (a - 1) * len(ALPHABET) + b - 1),
    )
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0))) / (F.length(string) - 1)


def with_spans(docs: DataFrame, model: list[float] | None, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with column ``into``: array of (start, kind, end), ordered, kinds numbered as in KINDS.

    All columns are kept; one named ``into`` is replaced. Whole texts are
    scanned; null and empty texts have no span. Candidates of the models are
    long runs of key characters; one that overlaps a base span is not repeated.
    """
    source = clean(F.col(text))
    base = [spare(docs, name) for name in ("base_spans", "model_spans")]
    none = F.expr("cast(array() as array<struct<start: bigint, kind: int, end: bigint>>)")
    learned = none if model is None else matches(source, CANDIDATE, 3, lambda m: ratio(m, model) >= THRESHOLD)
    held = docs.withColumns({base[0]: F.concat(*base_spans(source)), base[1]: learned})
    fresh = F.filter(base[1], lambda m: ~F.exists(
        base[0], lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return held.withColumn(into, F.array_sort(F.concat(base[0], fresh))).drop(*base)


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of ``docs``.

    A null text is empty and has no span. Rows are scanned one by one: null
    and repeated ids and repeated rows each give their own result.
    """
    found = with_spans(docs.select("doc_id", "text"), fit_model(docs)).select("doc_id", "secrets")
    number = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
    )
