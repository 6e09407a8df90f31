"""Secret scans: patterns, and a likelihood ratio of two character Markov models.

Native DataFrame functions only. The patterns find assignments to secret
names, access keys and long hexadecimal strings. Of the other long tokens, a
character Markov model of random strings and one of ordinary identifiers are
compared; a token whose log-likelihood ratio is high enough, in total and per
character, is a span, too, unless a pattern's span covers it whole; spans of
the two kinds may overlap. Both models are trained from labelled samples: the
values that the patterns find and strings drawn from hashes are random, the
other tokens of the sampled documents are ordinary. The sample is bounded by
``sample_docs`` (documents with the smallest hashes); the models are two tables
of character pairs, at most 67 * 66 each, and travel inside the expression.

Offsets are code points from 0, ends exclusive. Defined results: a NULL text is
empty and has no spans; an empty table gives no rows, and with nothing to learn
from the hashes alone are the random sample; repeated rows are rows of the
result; only the named columns are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import fresh

#: Fixed patterns, in the order of their kinds; the last number is the least length of the group.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 1, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]{32,}", 0, 32))
KINDS = ("assign", "access", "hex", "markov")
TOKEN = r"[A-Za-z0-9+/_=-]"
SPAN = "struct<start:int,kind:int,end:int>"


def spans_of(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0, keep=None) -> Column:
    """The leftmost matches of a pattern that do not overlap, as (start, kind, end); ``keep`` tests a match's text.

    The places come from the lengths of the matches and of what lies between
    them, which the same pattern splits off.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    marked = found if not group else F.arrays_zip(
        found.alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"))
    none = F.array().cast(f"array<{SPAN}>")

    def place(acc: Column, x: Column) -> Column:
        gap, whole, value = x["gap"], (x["m"]["m"] if group else x["m"]), (x["m"]["g"] if group else x["m"])
        start = acc["at"] + F.length(gap)
        end = start + F.length(whole)
        good = F.length(value) >= least if keep is None else (F.length(value) >= least) & keep(value)
        one = F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))
        return F.struct(end.cast("int").alias("at"), F.when(good, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def located(m: Column) -> Column:
        pairs = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(m)).alias("gap"), m.alias("m"))
        return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), place)["out"]

    useful = F.filter(marked, lambda x: F.length(x["g"] if group else x) >= least)
    return F.transform(F.array(marked), lambda m: F.when(F.size(useful) == 0, none).otherwise(located(m)))[0]


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), F.ascii)


def train_models(df: DataFrame, id_col: str = "doc_id", text: str = "text", sample_docs: int = 2000,
                 drawn: int = 2000, smooth: float = 0.5) -> list[float]:
    """The log-likelihood ratios of character pairs, random against ordinary, at 128 * first + second (0 starts a token)."""
    spark = df.sparkSession
    hashed = df.select(F.xxhash64(F.col(id_col).cast("string"), text).alias("h"), F.col(text).alias("text")).filter(F.length("text") > 0)
    top = hashed.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    labelled = _drawn_strings(spark, drawn)
    if top is not None:
        docs = hashed.filter(F.col("h") <= top).groupBy("h").agg(F.min("text").alias("text"))
        values = F.filter(F.concat(*[F.regexp_extract_all("text", F.lit(p), F.lit(g)) for _, p, g, _ in BASE]), lambda v: F.length(v) >= 8)
        plain = F.col("text")
        for _, p, _, _ in BASE:
            plain = F.regexp_replace(plain, p, " ")
        labelled = labelled.unionAll(docs.select(F.lit(1).alias("random"), F.explode(values).alias("token"))).unionAll(
            docs.select(F.lit(0).alias("random"), F.explode(F.regexp_extract_all(plain, F.lit(TOKEN + "{3,}"), F.lit(0))).alias("token")))
    codes = F.concat(F.array(F.lit(0)), _codes(F.col("token")))
    pairs = labelled.select("random", F.explode(F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes)), lambda a, b: 128 * a + b)).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    out = [0.0] * (128 * 128)
    alphabet = [c for c in range(128) if chr(c).isalnum() or chr(c) in "+/_=-"]
    for a in [0, *alphabet]:
        totals = [sum(counts.get((label, 128 * a + b), 0) for b in alphabet) + smooth * len(alphabet) for label in (0, 1)]
        for b in alphabet:
            p = [(counts.get((label, 128 * a + b), 0) + smooth) / totals[label] for label in (0, 1)]
            out[128 * a + b] = round(math.log(p[1] / p[0]), 4)
    return out


def _drawn_strings(spark: SparkSession, n: int) -> DataFrame:
    """(random, token): ``n`` each of hexadecimal, base64 and capital strings, drawn from hashes."""
    digest = F.sha2(F.concat(F.lit("drawn "), F.col("id").cast("string")), 256)
    coded = F.base64(F.unhex(digest))
    kinds = F.array(F.substring(digest, 1, 40), F.rtrim(coded, F.lit("=")), F.upper(F.substring(F.translate(coded, "+/=", ""), 1, 20)))
    return spark.range(n).select(F.lit(1).alias("random"), F.explode(kinds).alias("token"))


def ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, random against ordinary."""
    pairs = F.expr(f"cast(split('{','.join(map(str, table))}', ',') as array<double>)")
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(_codes(token), start, lambda a, c: F.struct(
        c.alias("last"), (a["sum"] + F.get(pairs, 128 * a["last"] + c)).alias("sum")))["sum"]


def scan_secrets(df: DataFrame, table: list[float], text: str = "text", least: int = 16, total: float = 20.0,
                 per_char: float = 0.6) -> DataFrame:
    """``df`` with ``base`` and ``spans``: arrays of (start, kind, end), the kind a place in ``KINDS``.

    Columns of these names are replaced.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    base = F.sort_array(F.concat(*[spans_of(t, p, k, g, n) for k, (_, p, g, n) in enumerate(BASE)]))

    def random(token: Column) -> Column:
        return F.transform(F.array(ratio(token, table)), lambda r: (r >= total) & (r >= per_char * F.length(token)))[0]

    found = spans_of(t, TOKEN + f"{{{least},}}", len(KINDS) - 1, 0, least, random)
    hidden = fresh(df, "found")
    out = df.withColumn("base", base).withColumn(hidden, found)
    added = F.filter(hidden, lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
    return out.withColumn("spans", F.when(F.size(hidden) == 0, F.col("base")).otherwise(F.sort_array(F.concat("base", added)))).drop(hidden)


def told(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined, in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with a mark in place of each span; overlapping spans are one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        clear = s["start"] >= a["at"]
        piece = F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(clear, piece).otherwise(a["out"]).alias("out"))

    done = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)
