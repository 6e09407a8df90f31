"""Dictionary phrases of any length in texts, without exploding n-grams.

A dictionary is indexed by the word, or the two words, that each term begins
with. Places of a text where some term begins go on, with the few words after
them, and the rest of the term is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.functions.joins import bounded_broadcast
from tidepool.session import materialize

# Words of a text that one row carries while it looks for terms.
SEGMENT = 32


def phrase_index(dictionary: DataFrame, term: str = "term") -> DataFrame:
    """(term, _key, _rest, _size): distinct terms by the word or two words that they begin with; terms are words with single blanks between."""
    words = F.split(F.col(term), " ")
    return (dictionary.select(F.col(term)).where(F.length(term) > 0).distinct()
            .select(term, F.array_join(F.slice(words, 1, 2), " ").alias("_key"), F.slice(words, F.lit(3), F.size(words)).alias("_rest"),
                    F.size(words).alias("_size")))


def phrase_hits(df: DataFrame, dictionary: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",),
                term: str = "term") -> DataFrame:
    """Every place of every dictionary term: ``keep`` columns, ``term``, ``at`` (its first word's place, from 0), ``size`` in words.

    Words of a text are lower-case and without the signs at their edges. All
    matches are given, also overlapping ones (``leftmost_longest`` chooses).
    A place looks up its word, and where there are longer terms its word and
    the next, whatever the lengths of the terms: two words, as a frequent first
    word may begin very many terms. Places meet the checked dictionary by
    broadcast, or beyond its bound by a shuffle on those words, which splits
    frequent ones; the rest of a term is compared word by word where its
    beginning was found.
    """
    index = materialize(phrase_index(dictionary, term))
    longest = index.agg(F.max("_size")).first()[0] or 1
    staged = df.select(*keep, tx.plain_words(text).alias("_words"))
    if longest == 1:
        # The outer form: a test for words beforehand would make them once more.
        rows = staged.select(*keep, F.lit(0).alias("_base"), F.posexplode_outer("_words").alias("_pos", "_word"))
    else:
        # Stretches of SEGMENT words and the few after them that a term may still need; a row never holds more of a text than that.
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("_words") - 1) / SEGMENT).cast("int")))
        parts = F.transform(starts, lambda k: F.struct((k * SEGMENT).alias("_base"), F.slice("_words", k * SEGMENT + 1, F.lit(SEGMENT + longest - 1)).alias("_seg")))
        rows = staged.select(*keep, F.inline_outer(parts))
        rows = rows.select(*keep, "_base", "_seg", F.posexplode(F.slice("_seg", 1, SEGMENT)).alias("_pos", "_word"))
        pair = F.concat("_word", F.lit(" "), F.get("_seg", F.col("_pos") + 1))
        rows = rows.select(*keep, "_base", "_seg", "_pos", F.explode(F.array("_word", pair)).alias("_word"))
    met = rows.join(bounded_broadcast(index), F.col("_word") == F.col("_key"))
    if longest > 2:
        met = met.where((F.col("_size") <= 2) | (F.slice("_seg", F.col("_pos") + 3, F.size("_rest")) == F.col("_rest")))
    return met.select(*keep, term, (F.col("_base") + F.col("_pos")).alias("at"), F.col("_size").alias("size"))


def leftmost_longest(hits: DataFrame, keep: Sequence[str] = ("doc_id",), term: str = "term") -> DataFrame:
    """The matches that a reader takes: from the left, the longest that begins there, then on from its end.

    Matches of a text are cut into islands that no match crosses, and the
    choice, which has to go in order, is made within an island.
    """
    best = hits.groupBy(*keep, "at").agg(F.max(F.struct("size", term)).alias("_m"))
    line = W.partitionBy(*keep).orderBy("at")
    reach = F.max(F.col("at") + F.col("_m.size")).over(line.rowsBetween(W.unboundedPreceding, -1))
    cut = best.withColumn("_new", (reach.isNull() | (F.col("at") >= reach)).cast("int"))
    cut = cut.withColumn("_island", F.sum("_new").over(line))
    one = F.struct("at", F.col("_m.size").alias("size"), F.col(f"_m.{term}").alias(term))
    grouped = cut.groupBy(*keep, "_island").agg(F.sort_array(F.collect_list(one)).alias("_all"))
    form = f"array<struct<at:int,size:int,`{term}`:string>>"
    taken = F.aggregate(
        "_all", F.struct(F.lit(0).alias("end"), F.array().cast(form).alias("kept")),
        lambda a, m: F.when(m["at"] >= a["end"], F.struct((m["at"] + m["size"]).alias("end"), F.concat(a["kept"], F.array(m)).alias("kept")))
        .otherwise(a), lambda a: a["kept"])
    return grouped.select(*keep, F.inline(taken)).select(*keep, term, "at", "size")
