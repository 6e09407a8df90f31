"""Scientific names: a finite-state machine over the words of a raw name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of words.
HYBRID = ("×", "x", "X")
OPEN = ("sp.", "spp.", "sp", "spp")
DOUBT = ("cf.", "aff.", "nr.")
RANKS = ("subsp.", "ssp.", "var.", "subvar.", "f.", "forma", "subf.")
PARTICLES = ("de", "da", "di", "du", "van", "von", "der", "den", "la", "le", "ex", "et", "in")
CAPITAL = r"^\p{Lu}[\p{Ll}-]+$"
LOWER = r"^[\p{Ll}][\p{Ll}-]+$"
SUBGENUS = r"^\(\p{Lu}[\p{Ll}-]+\)$"
YEAR = r"^\(?[12][0-9]{3}[a-z]?\)?,?$"

# States.
START, GENUS, SPECIES, RANK, INFRA, AUTHORITY, DATED, FAILED = range(8)
FIELDS = ("genus", "subgenus", "epithet", "rank", "infra", "qualifier", "authority", "year")


def parse_words(words: Column) -> Column:
    """The parts of a name from its words: a struct of ``FIELDS``, ``hybrid`` and ``state``.

    States and what leads on from them (anything else: see last line):

    * start: a hybrid mark stays; a capitalised word is the genus
    * genus: ``(Capitalised)`` is the subgenus, once; ``cf.``/``aff.``/``nr.``
      the qualifier; a hybrid mark stays; ``sp.``/``spp.`` is the qualifier and
      only an authority may follow; a lower-case word is the epithet
    * species: a rank mark; ``cf.`` and its like; a hybrid mark makes the next
      word the second parent (rank ``×``); a lower-case word is the infraspecific name
    * rank: a lower-case word is the infraspecific name
    * infra: another rank mark starts anew
    * authority: words up to a year, which ends the name

    From genus, species, infra and authority any other word (particles such as
    ``von`` too) belongs to the authority and a year ends the name; from start,
    rank, and after the year anything else fails.
    """
    none = F.lit(None).cast("string")
    first = F.struct(F.lit(START).alias("state"), F.lit(False).alias("hybrid"), *[none.alias(f) for f in FIELDS])

    def step(a: Column, w: Column) -> Column:
        s = a["state"]
        mark, open_, doubt, rank = w.isin(*HYBRID), w.isin(*OPEN), w.isin(*DOUBT), w.isin(*RANKS)
        low, year = w.rlike(LOWER) & ~w.isin(*PARTICLES) & ~mark & ~open_ & ~rank, w.rlike(YEAR)
        named = s.isin(GENUS, SPECIES, INFRA)
        to_genus = (s == START) & w.rlike(CAPITAL) & ~mark
        to_sub = (s == GENUS) & a["subgenus"].isNull() & a["qualifier"].isNull() & w.rlike(SUBGENUS)
        to_open = (s == GENUS) & open_
        to_doubt = s.isin(GENUS, SPECIES) & doubt
        to_epithet = (s == GENUS) & low
        to_rank = s.isin(SPECIES, INFRA) & rank
        to_cross = (s == SPECIES) & mark
        to_infra = s.isin(SPECIES, RANK) & low
        on_mark = s.isin(START, GENUS) & mark
        to_year = (named | (s == AUTHORITY)) & year
        part = to_genus | to_sub | to_open | to_doubt | to_epithet | to_rank | to_cross | to_infra | on_mark | to_year
        to_authority = ~part & (named | (s == AUTHORITY))
        state = (F.when(to_genus, GENUS).when(to_sub | to_doubt | on_mark, s).when(to_open | to_authority, AUTHORITY).when(to_epithet, SPECIES)
                 .when(to_rank | to_cross, RANK).when(to_infra, INFRA).when(to_year, DATED).otherwise(FAILED))
        return F.struct(
            state.alias("state"), (a["hybrid"] | on_mark | to_cross).alias("hybrid"),
            F.when(to_genus, w).otherwise(a["genus"]).alias("genus"),
            F.when(to_sub, F.translate(w, "()", "")).otherwise(a["subgenus"]).alias("subgenus"),
            F.when(to_epithet, w).otherwise(a["epithet"]).alias("epithet"),
            F.when(to_rank, w).when(to_cross, F.lit("×")).otherwise(a["rank"]).alias("rank"),
            F.when(to_infra, w).otherwise(a["infra"]).alias("infra"),
            F.when(to_open | to_doubt, w).otherwise(a["qualifier"]).alias("qualifier"),
            F.when(to_authority, F.concat_ws(" ", a["authority"], w)).otherwise(a["authority"]).alias("authority"),
            F.when(to_year, F.translate(w, "(),", "")).otherwise(a["year"]).alias("year"))

    return F.aggregate(words, first, step)


def parse_names(df: DataFrame, name: str, out: str = "parsed") -> DataFrame:
    """``df`` with ``out``, a struct: kind, hybrid, genus, subgenus, epithet, rank, infra, qualifier, authority, year, moved.

    ``kind`` is uninomial, binomial, trinomial or open (``sp.``, ``cf.`` and the
    like), by the parts found; NULL, as all parts are, where no name was found.
    ``moved``: the authority stands in brackets, that is, the species was
    described in another genus. Authorities are given without brackets and the
    comma before the year. A ``×`` may touch the word after it. All of it is
    expressions within the row.
    """
    clean = F.regexp_replace(F.regexp_replace(F.col(name), "×", "× "), r"[ \t\r\n]+", " ")
    p = F.col("_parsed")
    fine = ~p["state"].isin(START, RANK, FAILED)
    kind = (F.when(p["qualifier"].isNotNull(), "open").when(p["infra"].isNotNull(), "trinomial")
            .when(p["epithet"].isNotNull(), "binomial").otherwise("uninomial"))
    authority = F.nullif(F.regexp_replace(F.translate(p["authority"], "()", ""), r"[ ,]+$", ""), F.lit(""))
    parts = {"kind": kind, "hybrid": p["hybrid"], **{f: p[f] for f in FIELDS[:6]}, "authority": authority, "year": p["year"].cast("string"),
             "moved": F.coalesce(p["authority"].startswith("("), F.lit(False))}
    return (df.withColumn("_parsed", parse_words(F.filter(F.split(F.coalesce(clean, F.lit("")), " "), lambda w: w != "")))
            .withColumn(out, F.struct(*[F.when(fine, c).alias(n) for n, c in parts.items()])).drop("_parsed"))
