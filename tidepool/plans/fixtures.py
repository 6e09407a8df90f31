"""Derived analog inputs, built lazily from the test tables.

Each function mirrors one CTE of ``tidepool.plans.oracle`` and reads the
parquet tables of one scale-factor folder; the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.functions.joins import bounded_broadcast
from tidepool.operators.clean import disambiguate_names
from tidepool.session import dealt_by_weight, materialize

# The analog stop list for web tokens.
WEB_STOP_WORDS = ("the", "and", "of", "to", "a", "in", "is", "that")


class Tables:
    """Lazy readers for the parquet tables of one folder (one scan object each)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]


def _per_tables(fn):
    """Build each derived input once per ``Tables`` (one plan, one size check)."""
    import functools

    @functools.wraps(fn)
    def wrapper(t: Tables) -> DataFrame:
        key = f"fx:{fn.__name__}"
        if key not in t._frames:
            t._frames[key] = fn(t)
        return t._frames[key]
    return wrapper


@_per_tables
def authorships(t: Tables) -> DataFrame:
    """One row per (work, institution) link, written once: the largest table is
    read once, and pair sizes, pairs, works and countries come from the links."""
    li = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    su = t.supplier.select("s_suppkey", "s_nationkey")
    na = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    re = t.region.select("r_regionkey", "r_name")
    return materialize(li.join(su, li.l_suppkey == su.s_suppkey)
            .join(na, su.s_nationkey == na.n_nationkey)
            .join(re, na.n_regionkey == re.r_regionkey)
            .select(F.col("l_orderkey").alias("id"),
                    F.concat(F.lit("Inst#"), (F.col("s_suppkey") % 40).cast("string"))
                    .alias("display_name"),
                    F.col("n_name").alias("country_code"), F.col("r_name").alias("region"),
                    F.col("s_suppkey").alias("institution_id")))


@_per_tables
def inst(t: Tables) -> DataFrame:
    """The links with names unique per country, written once: works, countries and pairs come from them."""
    return materialize(disambiguate_names(authorships(t), "display_name", "country_code"))


@_per_tables
def grants(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey")
    pa = t.part.select("p_partkey", "p_brand")
    return materialize(li.join(pa, li.l_partkey == pa.p_partkey)
                       .select(F.col("l_orderkey").alias("id"), F.col("p_brand").alias("funder")).distinct())


@_per_tables
def web(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url", tx.url_host("url").alias("host"),
                          tx.strip_tags("html").alias("text"))


@_per_tables
def tokens(t: Tables) -> DataFrame:
    toks = tx.remove_stop_words(tx.tokenize("text"), WEB_STOP_WORDS)
    return web(t).select("page_id", "url", "host", F.explode(toks).alias("w"))


def _bench_words(t: Tables) -> DataFrame:
    return t.benchmark.select(F.explode(F.split(F.lower("text"), " ")).alias("w"))


@_per_tables
def dict_a(t: Tables) -> DataFrame:
    return (_bench_words(t).where(F.length("w").between(5, 7))
            .select(F.col("w").alias("term"),
                    F.when(F.length("w") % 2 == 0, F.lit("COMMON")).otherwise(F.lit("TAXONOMIC"))
                    .alias("label"))
            .distinct())


@_per_tables
def dict_b(t: Tables) -> DataFrame:
    return _bench_words(t).where(F.length("w").between(8, 9)).select(F.col("w").alias("term")).distinct()


@_per_tables
def dtok(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(tx.tokenize("text")).alias("w"))


# Bytes of text whose words one task makes; orders' lengths whose terms it makes.
TEXT_BYTES = 16 << 20
SPECIES_ROWS = 1 << 15


def dtok_with(t: Tables, *columns: str) -> DataFrame:
    """``dtok`` joined with ``columns`` of the documents on doc_id.

    Texts are joined before words are made of them, so that no words are
    shuffled or sorted, and a task's share of text is bounded.
    """
    texts = dealt_by_weight(t.documents.select("doc_id", "text"), F.octet_length("text"), TEXT_BYTES, "doc_id")
    met = texts.join(t.documents.select("doc_id", *columns), "doc_id")
    return met.select("doc_id", F.explode(tx.tokenize("text")).alias("w"), *columns)


@_per_tables
def sents(t: Tables) -> DataFrame:
    return (t.documents.select("doc_id", F.posexplode(tx.split_sentences("text")).alias("sentno", "s"))
            .where(F.trim("s") != ""))


@_per_tables
def criteria(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "lang", "n_chars", "source")
    lb = t.labels.select("doc_id", "quality", "toxic")
    return d.join(lb, "doc_id", "left").select(
        "doc_id",
        (F.col("lang") == "en").alias("c_lang"),
        (F.col("n_chars") > 1000).alias("c_long"),
        F.col("source").isin("src1", "src2", "src3").alias("c_src"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("c_quality"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("c_toxic"),
    )


@_per_tables
def patents(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("o_orderkey").alias("pub_id"), F.col("o_custkey").alias("family_id"),
                    (F.col("o_custkey") * 10 + F.col("o_orderkey") % 3).alias("appln_id"),
                    F.col("o_orderdate").alias("filing_date"), F.col("n_name").alias("country"),
                    F.col("c_mktsegment").alias("applicant_kind"),
                    F.col("o_orderstatus").alias("section"),
                    F.year("o_orderdate").alias("pub_year")))


@_per_tables
def occurrences(t: Tables) -> DataFrame:
    li = t.lineitem
    outside = (F.when(F.col("l_partkey") % 4 == 0, F.lit(True))
               .when(F.col("l_partkey") % 4 == 1, F.lit(False))
               .otherwise(F.col("l_returnflag") == "N"))
    return li.select(F.col("l_partkey").alias("taxon"),
                     ((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R")).alias("nonmarine"),
                     outside.alias("outside_eez"))


@_per_tables
def points(t: Tables) -> DataFrame:
    e = t.embeddings
    return e.select("vec_id",
                    F.round(F.col("embedding")[0].cast("double"), 6).alias("x"),
                    F.round(F.col("embedding")[1].cast("double"), 6).alias("y"))


@_per_tables
def embedding_polygons(t: Tables) -> DataFrame:
    """Each embedding as a polygon: vertex i = (e[2i], e[2i+1]), vertices in
    angle order around the origin (a star-shaped ring), as edge rows.

    Built inside each row (array sort, no window, no shuffle); the ring is
    staged as a column so the edge lambda indexes a ready array.
    """
    e = F.col("embedding")
    k = (F.size(e) / 2).cast("int")
    verts = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.struct(
        F.atan2(F.get(e, 2 * i + 1).cast("double"), F.get(e, 2 * i).cast("double")).alias("a"),
        F.get(e, 2 * i).cast("double").alias("x"),
        F.get(e, 2 * i + 1).cast("double").alias("y")))
    rings = t.embeddings.select(F.col("vec_id").alias("poly_id"), F.array_sort(verts).alias("ring"))
    r = F.col("ring")
    n = F.size(r)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1"),
        F.get(r, F.pmod(i + 1, n))["x"].alias("x2"), F.get(r, F.pmod(i + 1, n))["y"].alias("y2")))
    return rings.select("poly_id", F.inline(edges))


@_per_tables
def citing_lines(t: Tables) -> DataFrame:
    """Citations as they come, one for each line."""
    return (t.lineitem.where(F.col("l_orderkey") != F.col("l_partkey"))
            .select(F.col("l_orderkey").alias("citing"), F.col("l_partkey").alias("cited")))


@_per_tables
def cites(t: Tables) -> DataFrame:
    return citing_lines(t).distinct()


@_per_tables
def listings(t: Tables) -> DataFrame:
    term = (F.when(F.col("p_partkey") % 3 == 0, F.lit("blue ring"))
            .when(F.col("p_partkey") % 3 == 1, F.lit("old bolt")).otherwise(F.lit("hot gear")))
    return t.part.select(F.col("p_partkey").alias("asin"), F.col("p_name").alias("title"),
                         F.col("p_type").alias("category"), term.alias("search_term"))


@_per_tables
def seq(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id",
                           F.when(F.col("event_id") % 5 == 0, F.col("event_type")).alias("label"))


@_per_tables
def bench_units(t: Tables) -> DataFrame:
    """Distinct words and two-word phrases of the benchmark texts."""
    from tidepool.operators import text
    return text.units(t.benchmark, "text", keep=["item_id"], out="term").select("term").distinct()


@_per_tables
def applicant_domains(t: Tables) -> DataFrame:
    """(applicant, host): machinery customers, and hosts whose length has their number's remainder by 7."""
    c = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("applicant"), (F.col("c_custkey") % 7).alias("_m"))
    h = web(t).select("host").distinct().withColumn("_m", (F.length("host") % 7).cast("bigint"))
    return c.join(h, "_m").select("applicant", "host")


@_per_tables
def applicant_species(t: Tables) -> DataFrame:
    """(applicant, term): for machinery customers, dictionary terms whose length is 5 more than an order number's remainder by 3."""
    own = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select(F.col("c_custkey").alias("applicant"))
    o = t.orders.select(F.col("o_custkey").alias("applicant"), (F.col("o_orderkey") % 3 + 5).alias("_n")).distinct().join(own, "applicant")
    d = dict_a(t).select("term", F.length("term").cast("bigint").alias("_n"))
    # Few bytes that make very many rows: dealt by their count, not by their bytes.
    return dealt_by_weight(materialize(o), F.lit(1), SPECIES_ROWS, "applicant").join(bounded_broadcast(d), "_n").select("applicant", "term")


@_per_tables
def bench_phrases(t: Tables) -> DataFrame:
    """Terms of one to six words: the words of each benchmark text in turn, one, two, three and so on at a time."""
    from tidepool.functions import text as tx
    words = t.benchmark.select(tx.plain_words("text").alias("ws"))
    each = words.select("ws", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("k")).withColumn("a", (F.col("k") * (F.col("k") - 1) / 2 + 1).cast("int"))
    return each.where(F.size("ws") >= F.col("a") + F.col("k") - 1).select(F.array_join(F.slice("ws", "a", "k"), " ").alias("term")).distinct()


@_per_tables
def sentence_names(t: Tables) -> DataFrame:
    """(doc_id, name): the words of each document's first and last sentence, as two names of one record."""
    said = F.filter(F.transform(tx.split_sentences("text"), lambda s: F.array_join(tx.plain_words(s), " ")), lambda s: s != "")
    n = t.documents.select("doc_id", said.alias("said")).where(F.size("said") > 0)
    return n.select("doc_id", F.explode(F.array(F.get("said", F.lit(0)), F.element_at("said", -1))).alias("name"))


@_per_tables
def raw_names(t: Tables) -> DataFrame:
    """Raw scientific names: a part's two words in one of eight forms, and the first three words of each sentence."""
    first, second = F.initcap(F.split_part("p_name", F.lit(" "), F.lit(1))), F.split_part("p_name", F.lit(" "), F.lit(2))
    kind, year = F.lower("p_type"), (F.col("p_size") + 1750).cast("string")
    author = F.regexp_replace("p_brand", "[^A-Za-z]", "")
    forms = [F.concat_ws(" ", first, second), F.concat(first, F.lit(" "), second, F.lit(" ("), author, F.lit(", "), year, F.lit(")")),
             F.concat(first, F.lit(" ("), F.initcap("p_type"), F.lit(") "), second, F.lit(" "), author, F.lit(", "), year),
             F.concat(first, F.lit(" cf. "), second), F.concat(first, F.lit(" "), second, F.lit(" var. "), kind, F.lit(" "), author),
             F.concat(F.lit("×"), first, F.lit(" "), second), F.concat(first, F.lit(" sp. "), year), F.col("p_name")]
    made = F.element_at(F.array(*forms), (F.col("p_partkey") % 8 + 1).cast("int"))
    words = F.filter(F.split("s", " "), lambda w: w != "")
    return t.part.select(made.alias("name")).unionByName(sents(t).select(F.array_join(F.slice(words, 1, 3), " ").alias("name")))
