"""Quality rules with cross-document line frequency.

Native DataFrame functions only. Row-local rules count words, symbols,
repeated lines and repeated five-word windows. Across documents, normalised
lines (lower case, runs of blanks as one) are hashed, the documents of a host
that hold a line are counted, lines above a limit are taken out (an absolute
number on any host, a share on small ones), and a document that has too little
left is rejected.

The line counts are aggregated before they are shuffled, by (host, line), so a
host or a line with a third of all rows is no task's alone. Documents of a
host with the same text count once: copies are for deduplication to remove.

Defined results: a NULL or empty text has no words and fails the base rules; a
NULL host is a host of its own; repeated rows are rows of the result; an empty
table gives no rows; only the named columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import BLANK_RUN, bare, words, written

SYMBOLS = "#*$%&|<>"
SPAN = 5


def repeat_words(w: Column) -> Column:
    """Words inside five-word windows that are found twice or more in the word list ``w``.

    Windows are compared by hash first; only a list with equal hashes compares
    the windows themselves.
    """
    def windows(make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - SPAN), make)

    hashes = windows(lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SPAN)]))
    placed = F.sort_array(windows(lambda i: F.struct(F.array_join(F.slice(w, i + 1, SPAN), " ").alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        total = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(-SPAN).alias("last")), lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(SPAN), i - a["last"])).alias("n"), i.alias("last")))
        return total["n"]

    return (F.when(F.size(w) <= SPAN, 0)
            .when(F.size(F.array_distinct(hashes)) == F.size(w) - SPAN + 1, 0)
            .otherwise(F.transform(F.array(placed), covered)[0]))


def base_rules(df: DataFrame, text: str = "text", words_col: str = "w", lines_col: str = "lines") -> DataFrame:
    """``df`` with the row-local counts and ``base_failed``; ``words_col`` and ``lines_col`` stay for later use."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = df.withColumns({
        words_col: words(F.col(text)), "solid": bare(F.col(text)),
        lines_col: F.filter(F.split(whole, "\n"), lambda x: F.length(bare(x)) > 0)})
    out = out.withColumns({
        "n_words": F.size(words_col).cast("long"), "word_chars": F.length("solid").cast("long"),
        "n_symbols": (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines_col) - F.size(F.array_distinct(lines_col))).cast("long"),
        "n_repeat_words": repeat_words(F.col(words_col)).cast("long")}).drop("solid")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def line_rules(df: DataFrame, id_col: str = "doc_id", text: str = "text", host: str = "source",
               min_docs: int = 20, share: float = 0.05, most_docs: int = 1000, min_left: int = 10, min_left_share: float = 0.33) -> DataFrame:
    """One row per row of ``df``: the base counts, ``n_frequent_words`` (in removed lines) and ``kept``.

    A line is removed from the documents of a host if more than ``most_docs``
    of the host's distinct documents hold it, whatever the host's size, or, on
    smaller hosts, more than ``min_docs`` and more than ``share`` of them. A
    document is depleted if fewer than ``min_left`` words, or less than
    ``min_left_share`` of its words, are left.
    """
    lined = base_rules(df.select(F.col(id_col).alias("id"), F.col(host).alias("host"), F.col(text).alias("text")))
    base = written(lined.select(
        "id", "host", F.xxhash64("text").alias("text_hash"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.monotonically_increasing_id().alias("row"), F.transform("lines", lambda x: F.struct(
            F.xxhash64(F.lower(F.regexp_replace(F.btrim(x, F.lit(" \t\x0b\x0c\r")), BLANK_RUN, " "))).alias("h"),
            F.size(words(x)).alias("n"))).alias("lines")), "line-rules")

    # One row for each text of a host; a NULL host groups with NULL.
    first = base.groupBy("host", "text_hash", "n_words").agg(F.min("row").alias("row"))
    hosts = first.groupBy("host").agg(F.count("*").alias("host_docs"))
    seen = (base.join(first.select("row"), "row", "left_semi")
            .select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
            .groupBy("host", "h").agg(F.count("*").alias("docs")).filter(F.col("docs") > min_docs))
    frequent = (seen.withColumnRenamed("host", "of").join(hosts, F.col("of").eqNullSafe(F.col("host")))
                .filter((F.col("docs") > share * F.col("host_docs")) | (F.col("docs") > most_docs)).select("of", F.col("h").alias("line")))
    held = base.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.n")
    lost = (held.join(frequent, (F.col("h") == F.col("line")) & F.col("host").eqNullSafe(F.col("of")))
            .groupBy("row").agg(F.sum("n").alias("n_frequent_words")))
    out = base.join(lost, "row", "left").withColumn("n_frequent_words", F.coalesce("n_frequent_words", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_frequent_words")
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (
        ~F.col("base_failed") & (left >= min_left) & (left >= min_left_share * F.col("n_words"))).alias("kept"), "n_frequent_words")

