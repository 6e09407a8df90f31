"""DuckDB oracle SQL for every registered analog query.

Each entry is self-contained ANSI SQL over the pre-registered test views
(``lineitem``, ``supplier``, ``documents``, ...). Derived inputs are CTEs that
mirror ``tidepool.plans.fixtures``; column names and types match the Spark
side (counts BIGINT, doubles rounded to 6 places).
"""

from __future__ import annotations

import re

# Derived inputs, one CTE each. Names match tidepool.plans.fixtures.
CTES: dict[str, str] = {
    "authorships": """
        SELECT DISTINCT l_orderkey AS id,
               'Inst#' || CAST(s_suppkey % 40 AS VARCHAR) AS display_name,
               n_name AS country_code, r_name AS region, s_suppkey AS institution_id
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "inst": """
        SELECT id, institution_id, country_code, region,
               CASE WHEN count(DISTINCT country_code) OVER (PARTITION BY display_name) > 1
                    THEN display_name || ' (' || country_code || ')'
                    ELSE display_name END AS display_name
        FROM authorships""",
    "grants": """
        SELECT DISTINCT l_orderkey AS id, p_brand AS funder
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "web": """
        SELECT page_id, url,
               nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/:?#@]+)', 2), '') AS host,
               trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'),
                                   '[ \t\r\n]+', ' ', 'g')) AS text
        FROM pages""",
    "tokens": """
        SELECT page_id, url, host, w FROM (
            SELECT page_id, url, host, unnest(string_split(lower(text), ' ')) AS w FROM web)
        WHERE w <> '' AND w NOT IN ('the', 'and', 'of', 'to', 'a', 'in', 'is', 'that')""",
    "dict_a": """
        SELECT DISTINCT w AS term,
               CASE WHEN length(w) % 2 = 0 THEN 'COMMON' ELSE 'TAXONOMIC' END AS label
        FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark)
        WHERE length(w) BETWEEN 5 AND 7""",
    "dict_b": """
        SELECT DISTINCT w AS term
        FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark)
        WHERE length(w) BETWEEN 8 AND 9""",
    "dtok": """
        SELECT doc_id, w FROM (
            SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents)
        WHERE w <> ''""",
    "sents": """
        SELECT doc_id, s FROM (
            SELECT doc_id, unnest(regexp_split_to_array(text, '[.!?]+[ ]+|\n+')) AS s
            FROM documents)
        WHERE trim(s) <> ''""",
    "criteria": """
        SELECT d.doc_id, lang = 'en' AS c_lang, n_chars > 1000 AS c_long,
               source IN ('src1', 'src2', 'src3') AS c_src,
               coalesce(quality = 1, false) AS c_quality,
               coalesce(toxic = 1, false) AS c_toxic
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "patents": """
        SELECT o_orderkey AS pub_id, o_custkey AS family_id,
               o_custkey * 10 + o_orderkey % 3 AS appln_id, o_orderdate AS filing_date,
               n_name AS country, c_mktsegment AS applicant_kind,
               o_orderstatus AS section, year(o_orderdate) AS pub_year
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey""",
    "occurrences": """
        SELECT l_partkey AS taxon, l_linenumber = 7 AND l_returnflag = 'R' AS nonmarine,
               CASE l_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false
                    ELSE l_returnflag = 'N' END AS outside_eez
        FROM lineitem""",
    "points": """
        SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS x,
               round(CAST(embedding[2] AS DOUBLE), 6) AS y
        FROM embeddings""",
    "cites": """
        SELECT DISTINCT l_orderkey AS citing, l_partkey AS cited
        FROM lineitem WHERE l_orderkey <> l_partkey""",
    "listings": """
        SELECT p_partkey AS asin, p_name AS title, p_type AS category,
               CASE p_partkey % 3 WHEN 0 THEN 'blue ring' WHEN 1 THEN 'old bolt'
                    ELSE 'hot gear' END AS search_term
        FROM part""",
    "seq": """
        SELECT event_id, user_id,
               CASE WHEN event_id % 5 = 0 THEN event_type END AS label
        FROM events""",
}

# CTE dependencies (a CTE must come after the ones it reads).
_DEPS: dict[str, tuple[str, ...]] = {
    "inst": ("authorships",),
    "tokens": ("web",),
}


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it names (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def _pairs(source: str, item: str, feature: str) -> str:
    return f"""
        e AS (SELECT DISTINCT {item} AS item, {feature} AS feature FROM {source}
              WHERE {item} IS NOT NULL AND {feature} IS NOT NULL),
        pairs AS (SELECT a.item AS item1, b.item AS item2, count(*) AS n
                  FROM e a JOIN e b ON a.feature = b.feature AND a.item < b.item
                  GROUP BY a.item, b.item)"""


def _rescale_sql(v: str, lo: int = 5, hi: int = 100) -> str:
    """Exact half-up rounding to 6 places of lo + (hi-lo)*(v-mn)/(mx-mn)."""
    mn, mx = f"min({v}) OVER ()", f"max({v}) OVER ()"
    span = f"({mx} - {mn})"
    num = f"({lo} * {span} + {hi - lo} * ({v} - {mn}))"
    return (f"CASE WHEN {mx} = {mn} THEN {(lo + hi) / 2} "
            f"ELSE CAST(({num} * 2000000 + {span}) // (2 * {span}) AS DOUBLE) / 1000000 END")


_INST_LINKS = _pairs("inst", "display_name", "id")
_INST_WORKS = """
        works AS (SELECT display_name AS name, count(DISTINCT id) AS works
                  FROM inst GROUP BY display_name)"""
_INST_DEGREE = """
        degree AS (SELECT name, CAST(sum(n) AS BIGINT) AS total_collaborations FROM (
                     SELECT item1 AS name, n FROM pairs UNION ALL SELECT item2, n FROM pairs)
                   GROUP BY name)"""
_INST_NODES = """
        country AS (SELECT DISTINCT display_name AS name, country_code FROM inst),
        med AS (SELECT quantile_cont(works, 0.5) AS m FROM works),
        kept AS (SELECT w.name, c.country_code AS category, w.works AS value
                 FROM works w JOIN country c USING (name) WHERE w.works >= (SELECT m FROM med)),
        nodes AS (SELECT name, category, value, """ + _rescale_sql("value") + """ AS symbol_size
                  FROM kept)"""


def _q(body: str, *ctes: str, extra: str = "") -> str:
    """Compose: named fixture CTEs, then ad-hoc CTEs in ``extra``, then body."""
    sql = with_ctes("SELECT 1", *ctes)
    if extra:
        head = sql[: -len("SELECT 1")].rstrip()
        head = (head + ",\n" if head else "WITH ") + extra.strip()
        return head + "\n" + body.strip()
    return sql[: -len("SELECT 1")] + body.strip()


ORACLE: dict[str, str] = {
    # ---- collaboration networks -------------------------------------------
    "a01_disambiguate_names": _q(
        "SELECT DISTINCT display_name, country_code FROM inst", "inst"),
    "a02_recode_group_works": _q(
        """SELECT funder, count(DISTINCT id) AS works FROM (
               SELECT id, CASE WHEN funder IN ('Brand#1', 'Brand#2', 'Brand#3')
                               THEN 'GROUP' ELSE funder END AS funder FROM grants)
           GROUP BY funder""", "grants"),
    "a03_crosswalk": _q(
        """SELECT s_suppkey, n_name AS code,
                  coalesce(CASE WHEN r_name = 'ASIA' THEN NULL ELSE r_name END,
                           'Unclassified') AS label
           FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
           LEFT JOIN region ON n_regionkey = r_regionkey"""),
    "a04_institution_pairs": _q(
        "SELECT item1, item2, n FROM pairs", "inst", extra=_INST_LINKS),
    "a05_funder_pairs": _q(
        "SELECT item1, item2, n FROM pairs", "grants", extra=_pairs("grants", "funder", "id")),
    "a06_country_pairs": _q(
        "SELECT item1, item2, n FROM pairs", "authorships",
        extra=_pairs("authorships", "country_code", "id")),
    "a07_weighted_degree": _q(
        "SELECT name, total_collaborations FROM degree", "inst",
        extra=_INST_LINKS + "," + _INST_DEGREE),
    "a08_distinct_works": _q(
        "SELECT name, works FROM works", "inst", extra=_INST_WORKS),
    "a09_entity_table": _q(
        """SELECT d.name, c.country_code AS country, d.total_collaborations, w.works
           FROM degree d JOIN works w USING (name)
           JOIN (SELECT DISTINCT display_name AS name, country_code FROM inst) c USING (name)""",
        "inst", extra=_INST_LINKS + "," + _INST_DEGREE + "," + _INST_WORKS),
    "a10_rescale": _q(
        "SELECT name, works, " + _rescale_sql("works") + " AS symbol_size FROM works",
        "inst", extra=_INST_WORKS),
    "a11_graph_nodes": _q(
        """SELECT name, category, value, symbol_size, symbol_size > 16 AS show_label FROM nodes""",
        "inst", extra=_INST_WORKS + "," + _INST_NODES),
    "a12_graph_links": _q(
        """SELECT DISTINCT item1 AS source, item2 AS target FROM pairs
           WHERE item1 IN (SELECT name FROM nodes) AND item2 IN (SELECT name FROM nodes)""",
        "inst", extra=_INST_LINKS + "," + _INST_WORKS + "," + _INST_NODES),
    "a13_graph_categories": _q(
        "SELECT DISTINCT category AS name FROM nodes",
        "inst", extra=_INST_WORKS + "," + _INST_NODES),
    "a14_ego_network": _q(
        """SELECT item1 AS source, item2 AS target, n FROM pairs
           WHERE item1 = 'NATION_12' OR item2 = 'NATION_12'""", "authorships",
        extra=_pairs("authorships", "country_code", "id")),
}

_BIGRAMS = """
        pw AS (SELECT page_id, string_split(lower(text), ' ') AS ws FROM web),
        bigrams AS (SELECT page_id, ws[i] || ' ' || ws[i + 1] AS bigram
                    FROM (SELECT page_id, ws, unnest(range(1, len(ws))) AS i FROM pw))"""
_HITS_A = """
        hits AS (SELECT t.page_id, t.host, d.term, d.label FROM tokens t JOIN dict_a d ON t.w = d.term)"""

ORACLE.update({
    # ---- web text ---------------------------------------------------------
    "a15_unigrams": _q(
        "SELECT w AS ngram, count(*) AS n, count(DISTINCT page_id) AS pages FROM tokens GROUP BY w",
        "tokens"),
    "a16_bigrams": _q(
        "SELECT bigram AS ngram, count(*) AS n, count(DISTINCT page_id) AS pages FROM bigrams GROUP BY bigram",
        "web", extra=_BIGRAMS),
    "a17_host_counts": _q(
        "SELECT host, count(DISTINCT page_id) AS pages FROM web WHERE host IS NOT NULL GROUP BY host", "web"),
    "a18_dedupe_sentences": _q(
        "SELECT DISTINCT doc_id, s AS sentence FROM sents", "sents"),
    "a19_term_counts": _q(
        """SELECT term, label, count(DISTINCT page_id) AS pages, count(*) AS occurrences
           FROM hits GROUP BY term, label""", "tokens", "dict_a", extra=_HITS_A),
    "a20_label_counts": _q(
        """SELECT label, count(DISTINCT term) AS terms, count(DISTINCT page_id) AS pages,
                  count(*) AS occurrences FROM hits GROUP BY label""",
        "tokens", "dict_a", extra=_HITS_A),
    "a21_merged_term_counts": _q(
        """SELECT regexp_replace(term, '[.,]+$', '') AS term,
                  count(DISTINCT page_id) AS pages, count(*) AS occurrences
           FROM hits GROUP BY 1""", "tokens", "dict_a", extra=_HITS_A),
    "a22_cooccurring_documents": _q(
        """SELECT DISTINCT doc_id FROM dtok WHERE w IN (SELECT term FROM dict_a)
           INTERSECT
           SELECT DISTINCT doc_id FROM dtok WHERE w IN (SELECT term FROM dict_b)""",
        "dtok", "dict_a", "dict_b"),
    "a23_funnel": _q(
        """SELECT 1 AS stage_no, 'documents' AS stage, count(DISTINCT doc_id) AS documents FROM dtok
           UNION ALL
           SELECT 2, 'with_dict_a', count(DISTINCT doc_id) FROM dtok WHERE w IN (SELECT term FROM dict_a)
           UNION ALL
           SELECT 3, 'with_dict_a_and_b', count(*) FROM (
               SELECT DISTINCT doc_id FROM dtok WHERE w IN (SELECT term FROM dict_a)
               INTERSECT
               SELECT DISTINCT doc_id FROM dtok WHERE w IN (SELECT term FROM dict_b))""",
        "dtok", "dict_a", "dict_b"),
    "a24_term_density": _q(
        """SELECT doc_id, count(*) AS tokens, count(d.term) AS hits,
                  CAST((count(d.term) * 2000000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS density
           FROM dtok LEFT JOIN dict_a d ON dtok.w = d.term GROUP BY doc_id""",
        "dtok", "dict_a"),
})

_SCORE = """
        scored AS (SELECT doc_id,
                          CAST(CAST(c_lang AS INT) * 1 + CAST(c_long AS INT) * 2 + CAST(c_src AS INT) * 3
                               + CAST(c_quality AS INT) * 2 + CAST(c_toxic AS INT) * 1 AS BIGINT) AS total
                   FROM criteria)"""
_TAXA = """
        taxa AS (SELECT taxon, NOT bool_or(nonmarine) AS marine_only, bool_or(outside_eez) AS abnj,
                        bool_and(outside_eez) AS abnj_only, count(*) AS occurrences
                 FROM occurrences GROUP BY taxon)"""
_SEEDS = """
        seeds AS (SELECT DISTINCT o_orderkey AS work FROM orders WHERE o_orderpriority = '1-URGENT'),
        expanded AS (SELECT work FROM seeds
                     UNION SELECT c.cited FROM cites c JOIN seeds s ON c.citing = s.work
                     UNION SELECT c.citing FROM cites c JOIN seeds s ON c.cited = s.work)"""
_EPOLY = """
        rings AS (SELECT vec_id AS poly_id,
                         list_sort([{'a': atan2(CAST(embedding[2 * i + 2] AS DOUBLE), CAST(embedding[2 * i + 1] AS DOUBLE)),
                                     'x': CAST(embedding[2 * i + 1] AS DOUBLE),
                                     'y': CAST(embedding[2 * i + 2] AS DOUBLE)}
                                    FOR i IN range(len(embedding) // 2)]) AS ring
                  FROM embeddings),
        epoly AS (SELECT poly_id, ring[i + 1].x AS x1, ring[i + 1].y AS y1,
                         ring[(i + 1) % len(ring) + 1].x AS x2, ring[(i + 1) % len(ring) + 1].y AS y2
                  FROM (SELECT poly_id, ring, unnest(range(len(ring))) AS i FROM rings))"""
_INSIDE = """
        crossings AS (SELECT p.vec_id, e.poly_id, count(*) AS n FROM points p JOIN epoly e
                        ON (e.y1 > p.y) <> (e.y2 > p.y)
                       AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
                      GROUP BY p.vec_id, e.poly_id),
        inside AS (SELECT vec_id, bool_or(n % 2 = 1) AS inside FROM crossings GROUP BY vec_id)"""
_VOCAB = """
        vocab AS (SELECT DISTINCT d.lang, t.w FROM dtok t JOIN documents d USING (doc_id)
                  WHERE d.lang IN ('en', 'de')),
        flags AS (SELECT w, bool_or(lang = 'en') AS in_en, bool_or(lang = 'de') AS in_de
                  FROM vocab GROUP BY w)"""
_LISTINGS = """
        lw AS (SELECT asin, title, search_term, string_split(title, ' ') AS words FROM listings),
        kept AS (SELECT * FROM lw WHERE NOT list_has_any(words, ['widget', 'anvil'])),
        anyw AS (SELECT * FROM kept WHERE list_has_any(words, string_split(search_term, ' '))),
        phrase AS (SELECT * FROM anyw WHERE contains(' ' || title || ' ', ' ' || search_term || ' '))"""
_TOP_HOSTS = """
        host_pages AS (SELECT host, count(DISTINCT page_id) AS pages FROM web WHERE host IS NOT NULL GROUP BY host),
        top_hosts AS (SELECT host FROM host_pages ORDER BY pages DESC, host LIMIT 3)"""

ORACLE.update({
    # ---- scoring, shares, quality, trends -----------------------------------
    "a25_weighted_score": _q("SELECT doc_id, total FROM scored", "criteria", extra=_SCORE),
    "a26_level_distribution": _q(
        """SELECT CAST(total AS VARCHAR) AS level, count(*) AS documents,
                  CAST(sum(count(*)) OVER (ORDER BY total DESC) AS BIGINT) AS at_least
           FROM scored GROUP BY total
           UNION ALL
           SELECT 'Total', count(*), count(*) FROM scored""", "criteria", extra=_SCORE),
    "a27_membership_share": _q(
        """SELECT region, count(DISTINCT id) AS works,
                  CAST((count(DISTINCT id) * 2000000 + (SELECT count(DISTINCT id) FROM authorships
                                                         WHERE region IS NOT NULL))
                       // (2 * (SELECT count(DISTINCT id) FROM authorships WHERE region IS NOT NULL))
                       AS DOUBLE) / 1000000 AS share
           FROM authorships WHERE region IS NOT NULL GROUP BY region""", "authorships"),
    "a28_region_rollup": _q(
        """SELECT region, country_code, CAST(GROUPING(region, country_code) AS INT) AS level,
                  count(DISTINCT id) AS works
           FROM authorships GROUP BY ROLLUP (region, country_code)""", "authorships"),
    "a29_field_coverage": _q(
        """SELECT d.source, count(*) AS documents, count(l.doc_id) AS labelled,
                  CAST((count(l.doc_id) * 2000000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS coverage
           FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)
           GROUP BY d.source"""),
    "a30_match_report": _q(
        """SELECT d.lang, count(*) AS documents, count(l.doc_id) AS matched,
                  count(*) - count(l.doc_id) AS unmatched
           FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)
           GROUP BY d.lang"""),
    "a31_year_trend": _q(
        """SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS status, count(*) AS n
           FROM orders GROUP BY 1, 2"""),
    "a32_top_k": _q(
        """SELECT p_name, count(*) AS n FROM part GROUP BY p_name
           ORDER BY n DESC, p_name LIMIT 10"""),
    # ---- taxa ---------------------------------------------------------------
    "a33_classify_taxa": _q(
        "SELECT taxon, marine_only, abnj, abnj_only, occurrences FROM taxa",
        "occurrences", extra=_TAXA),
    "a34_habitat_crosstab": _q(
        """SELECT p.p_type, count(*) AS taxa,
                  CAST(count_if(t.marine_only) AS BIGINT) AS marine_only,
                  CAST(count_if(t.abnj) AS BIGINT) AS abnj,
                  CAST(count_if(t.abnj_only) AS BIGINT) AS abnj_only
           FROM taxa t JOIN part p ON t.taxon = p.p_partkey GROUP BY p.p_type""",
        "occurrences", extra=_TAXA),
    "a35_extract_binomial": _q(
        """SELECT regexp_extract(p_name, '^([^ ]+)', 1) AS genus,
                  nullif(regexp_extract(p_name, '^[^ ]+ +([^ ]+)', 1), '') AS epithet,
                  count(*) AS n
           FROM part GROUP BY 1, 2"""),
    # ---- patents -------------------------------------------------------------
    "a36_first_filings": _q(
        """SELECT CAST(year(first_filing) AS INT) AS first_year, count(*) AS families FROM (
               SELECT family_id, min(filing_date) AS first_filing FROM patents GROUP BY family_id)
           GROUP BY 1""", "patents"),
    "a37_family_members": _q(
        """SELECT CAST(pub_year AS INT) AS pub_year, country, count(DISTINCT pub_id) AS members
           FROM patents GROUP BY 1, 2""", "patents"),
    "a38_three_way_counts": _q(
        """SELECT country, count(DISTINCT family_id) AS families,
                  count(DISTINCT appln_id) AS applications, count(DISTINCT pub_id) AS publications
           FROM patents GROUP BY country""", "patents"),
    "a39_claims_vs_text": _q(
        """SELECT country, count(DISTINCT CASE WHEN section = 'F' THEN pub_id END) AS in_claims,
                  count(DISTINCT pub_id) AS anywhere
           FROM patents WHERE applicant_kind <> 'HOUSEHOLD' GROUP BY country""", "patents"),
    # ---- places --------------------------------------------------------------
    "a40_classify_points": _q(
        """SELECT p.vec_id, p.x, p.y, coalesce(i.inside, false) AS inside,
                  CASE WHEN i.inside THEN 'EEZ' ELSE 'ABNJ' END AS place
           FROM points p LEFT JOIN inside i USING (vec_id)""",
        "points", extra=_EPOLY + "," + _INSIDE),
    "a41_centroid": _q(
        """SELECT poly_id, round(sum(x1 * y2 - x2 * y1) / 2, 6) AS area,
                  round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS cx,
                  round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)), 6) AS cy
           FROM epoly GROUP BY poly_id""", extra=_EPOLY),
    # ---- corpus --------------------------------------------------------------
    "a42_citation_expand": _q("SELECT work FROM expanded", "cites", extra=_SEEDS),
    "a43_citations_received": _q(
        "SELECT cited AS work, count(*) AS citations FROM cites GROUP BY cited", "cites"),
    "a44_compare_corpora": _q(
        """SELECT CASE WHEN in_en AND in_de THEN 'both' WHEN in_en THEN 'en_only'
                       ELSE 'de_only' END AS membership, count(*) AS terms
           FROM flags GROUP BY 1""", "dtok", extra=_VOCAB),
    # ---- listings --------------------------------------------------------------
    "a45_filter_listings": _q(
        """SELECT (SELECT count(*) FROM lw) AS listings, (SELECT count(*) FROM kept) AS after_stop_words,
                  (SELECT count(DISTINCT asin) FROM kept) AS distinct_listings,
                  (SELECT count(*) FROM anyw) AS any_word, (SELECT count(*) FROM phrase) AS full_phrase""",
        "listings", extra=_LISTINGS),
    "a46_applicant_domain_hits": _q(
        """SELECT t.host, t.w AS term, count(DISTINCT t.page_id) AS pages
           FROM tokens t JOIN dict_a d ON t.w = d.term
           WHERE t.host IN (SELECT host FROM web GROUP BY host HAVING count(DISTINCT page_id) >= 3)
           GROUP BY t.host, t.w""", "tokens", "dict_a"),
    # ---- cleaning / ranking helpers ------------------------------------------
    "a47_fill_down": _q(
        """SELECT event_id, user_id,
                  last_value(label IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label
           FROM seq""", "seq"),
    "a48_sum_numeric": _q(
        """SELECT p_brand, CAST(coalesce(sum(p_partkey), 0) AS BIGINT) AS p_partkey,
                  CAST(coalesce(sum(p_size), 0) AS BIGINT) AS p_size,
                  round(coalesce(sum(p_retailprice), 0), 6) AS p_retailprice
           FROM part GROUP BY p_brand"""),
    "a49_exclude_terms": _q(
        """SELECT w AS ngram, count(*) AS n, count(DISTINCT page_id) AS pages FROM tokens
           WHERE host NOT IN (SELECT host FROM top_hosts) GROUP BY w""",
        "tokens", extra=_TOP_HOSTS),
})


def _english_in_list() -> str:
    from tidepool.operators.text import english_stop_words
    return ", ".join("'" + w.replace("'", "''") + "'" for w in english_stop_words())


ORACLE.update({
    "a50_score_bands": _q(
        """SELECT CAST(count_if(total >= 4) AS BIGINT) AS at_least_4,
                  CAST(count_if(total >= 6) AS BIGINT) AS at_least_6 FROM scored""",
        "criteria", extra=_SCORE),
    "a51_trend_line": _q(
        """SELECT status, round(regr_slope(CAST(n AS DOUBLE), CAST(year AS DOUBLE)), 6) AS slope,
                  round(regr_intercept(CAST(n AS DOUBLE), CAST(year AS DOUBLE)), 6) AS intercept
           FROM (SELECT CAST(year(o_orderdate) AS INT) AS year, o_orderstatus AS status, count(*) AS n
                 FROM orders GROUP BY 1, 2)
           WHERE year < 2000 GROUP BY status"""),
    "a52_column_coverage": _q(
        """SELECT count(*) AS rows, CAST((count(l.quality) * 2000000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS quality,
                  CAST((count(l.toxic) * 2000000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 AS toxic
           FROM documents d LEFT JOIN labels l USING (doc_id)"""),
    "a53_family_size": _q(
        "SELECT family_id, count(DISTINCT pub_id) AS members FROM patents GROUP BY family_id",
        "patents"),
    "a54_undirected_pairs": _q(
        "SELECT item1, item2, n FROM pairs", "grants", extra=_pairs("grants", "funder", "id")),
    "a55_recode_types": _q(
        """SELECT CASE p_type WHEN 'ECONOMY' THEN 'BUDGET' WHEN 'PROMO' THEN 'SALE' ELSE p_type END AS p_type,
                  count(*) AS n FROM part GROUP BY 1"""),
    "a56_first_page_per_host": _q(
        "SELECT host, min(page_id) AS page_id, arg_min(url, page_id) AS url FROM web GROUP BY host",
        "web"),
    "a57_totals_row": _q(
        """SELECT p_type, count(*) AS n FROM part GROUP BY p_type
           UNION ALL SELECT 'Total', count(*) FROM part"""),
    "a58_outcome_share": _q(
        """SELECT quality, count(*) AS n,
                  CAST((count(*) * 2000000 + (SELECT count(*) FROM labels)) // (2 * (SELECT count(*) FROM labels)) AS DOUBLE) / 1000000 AS share
           FROM labels GROUP BY quality"""),
    "a59_reference_unigrams": _q(
        f"""SELECT trim(w) AS ngram, count(*) AS n FROM (
                SELECT unnest(regexp_split_to_array(solid, '[ \\t\\n\\x0B\\f\\r]')) AS w
                FROM (SELECT lower(text) AS t, regexp_replace(lower(text), '[ \\t\\n\\x0B\\f\\r]+$', '') AS solid FROM documents)
                WHERE solid <> '' OR t = '')
            WHERE w NOT IN ({_english_in_list()})
            GROUP BY 1"""),
})



def _units(name: str, columns: str, source: str, text: str) -> str:
    """A CTE of the distinct words, without signs at their edges, and two-word phrases of a text."""
    keep = "".join(c.strip() + ", " for c in columns.split(",") if c.strip() != "w")
    words = (f"list_filter(list_transform(regexp_split_to_array(lower({text}), '[ \\t\\r\\n]+'), "
             "lambda x: regexp_replace(x, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')), lambda x: x <> '')")
    return f"""
        {name}_w AS (SELECT {keep}{words} AS ws FROM {source}),
        {name} AS (SELECT DISTINCT {keep}w FROM (
                     SELECT {keep}unnest(ws) AS w FROM {name}_w
                     UNION ALL SELECT {keep}ws[i] || ' ' || ws[i + 1] AS w
                     FROM (SELECT {keep}ws, unnest(range(1, len(ws))) AS i FROM {name}_w)))"""


_SENTENCE_UNITS = "ds AS (SELECT DISTINCT doc_id, s FROM sents)," + _units("su", "doc_id, s, w", "ds", "s")
_HITS_TERMS = """
        hits AS (SELECT t.page_id, d.term FROM tokens t JOIN dict_a d ON t.w = d.term),
        vmap AS (SELECT a.term AS variant, b.term AS canonical FROM dict_a a JOIN dict_a b
                   ON regexp_replace(a.term, '[.,]+$', '') = b.term AND a.term <> b.term)"""
_PHRASES = """
        bw AS (SELECT list_filter(string_split(lower(text), ' '), lambda x: x <> '') AS ws FROM benchmark),
        bbi AS (SELECT DISTINCT ws[i] || ' ' || ws[i + 1] AS term
                FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM bw)),
        dict AS (SELECT term FROM dict_a UNION SELECT term FROM bbi),
        pw AS (SELECT page_id, string_split(lower(text), ' ') AS ws FROM web),
        pbi AS (SELECT page_id, ws[i] || ' ' || ws[i + 1] AS w
                FROM (SELECT page_id, ws, unnest(range(1, len(ws))) AS i FROM pw)),
        units AS (SELECT page_id, w FROM tokens UNION ALL SELECT page_id, w FROM pbi),
        hits AS (SELECT u.page_id, d.term FROM units u JOIN dict d ON u.w = d.term)"""

ORACLE.update({
    "a60_period_filings": _q(
        """SELECT CAST(year(first_filing) AS INT) AS first_year, count(*) AS families FROM (
               SELECT family_id, min(filing_date) AS first_filing FROM patents
               WHERE filing_date >= TIMESTAMP '1996-01-01' AND filing_date < TIMESTAMP '2000-01-01'
               GROUP BY family_id)
           GROUP BY 1""", "patents"),
    "a61_variant_map_counts": _q(
        """SELECT coalesce(v.canonical, h.term) AS term, count(DISTINCT h.page_id) AS pages,
                  count(*) AS occurrences
           FROM hits h LEFT JOIN vmap v ON h.term = v.variant GROUP BY 1""",
        "tokens", "dict_a", extra=_HITS_TERMS),
    "a62_phrase_hits": _q(
        """SELECT CASE WHEN regexp_matches(term, ' ') THEN 'phrase' ELSE 'word' END AS kind,
                  count(DISTINCT term) AS terms, count(DISTINCT page_id) AS pages, count(*) AS occurrences
           FROM hits GROUP BY 1""", "tokens", "dict_a", extra=_PHRASES),
    "a63_enrich_listings": _q(
        """SELECT l.asin, l.title, d.l_orderkey, d.l_linenumber, d.l_quantity
           FROM listings l LEFT JOIN (
               SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (
                   SELECT l_partkey, l_orderkey, l_linenumber, l_quantity,
                          row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber) AS rn
                   FROM lineitem) WHERE rn = 1) d ON l.asin = d.l_partkey""", "listings"),
})

ORACLE.update({
    "a64_funder_table_regroup_after": _q(
        """SELECT CASE WHEN d.name IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 'GROUP' ELSE d.name END AS name,
                  CAST(sum(d.total_collaborations) AS BIGINT) AS total_collaborations,
                  CAST(sum(w.works) AS BIGINT) AS works
           FROM (SELECT name, CAST(sum(n) AS BIGINT) AS total_collaborations FROM (
                     SELECT item1 AS name, n FROM pairs UNION ALL SELECT item2, n FROM pairs)
                 GROUP BY name) d
           JOIN (SELECT funder AS name, count(DISTINCT id) AS works FROM grants GROUP BY funder) w USING (name)
           GROUP BY 1""", "grants", extra=_pairs("grants", "funder", "id")),
})

ORACLE.update({
    "a65_country_nodes": _q(
        """SELECT d.name, coalesce(r_name, 'Unclassified') AS category, d.total_collaborations,
                  d.symbol_size
           FROM (SELECT name, total_collaborations, """ + _rescale_sql("total_collaborations") + """
                            AS symbol_size
                 FROM degree) d
           LEFT JOIN nation ON d.name = n_name LEFT JOIN region ON n_regionkey = r_regionkey
           WHERE d.total_collaborations >= (SELECT quantile_cont(total_collaborations, 0.5) FROM degree)""",
        "authorships", extra=_pairs("authorships", "country_code", "id") + "," + _INST_DEGREE),
})

ORACLE.update({
    "a66_sentence_hits": _q(
        """SELECT d.label, count(DISTINCT {'d': u.doc_id, 's': u.s}) AS sentences,
                  count(DISTINCT u.doc_id) AS documents
           FROM su u JOIN dict_a d ON u.w = d.term GROUP BY d.label""", "sents", "dict_a", extra=_SENTENCE_UNITS),
    "a73_sentence_phrases": _q(
        """SELECT CASE WHEN contains(u.w, ' ') THEN 'phrase' ELSE 'word' END AS label,
                  count(DISTINCT {'d': u.doc_id, 's': u.s}) AS sentences, count(DISTINCT u.doc_id) AS documents
           FROM su u JOIN bu ON u.w = bu.w GROUP BY 1""", "sents", extra=_SENTENCE_UNITS + "," + _units("bu", "w", "benchmark", "text")),
    "a74_cooccurring_sentences": _q(
        """SELECT doc_id, count(*) AS sentences FROM (
               SELECT DISTINCT doc_id, s FROM su WHERE w IN (SELECT term FROM dict_a)
               INTERSECT SELECT DISTINCT doc_id, s FROM su WHERE w IN (SELECT term FROM dict_b))
           GROUP BY doc_id""", "sents", "dict_a", "dict_b", extra=_SENTENCE_UNITS),
    "a75_applicant_species_pages": _q(
        """SELECT term, count(DISTINCT applicant) AS applicants, count(DISTINCT host) AS domains, max(pages) AS most_pages FROM (
               SELECT a.applicant, u.host, u.w AS term, count(DISTINCT u.page_id) AS pages
               FROM applicants a JOIN pu u ON a.host = u.host JOIN species sp ON sp.applicant = a.applicant AND sp.term = u.w
               WHERE u.host IN (SELECT host FROM web GROUP BY host HAVING count(DISTINCT page_id) >= 3)
               GROUP BY 1, 2, 3)
           GROUP BY term""", "web", "dict_a",
        extra=_units("pu", "page_id, host, w", "web", "text") + """,
        applicants AS (SELECT c_custkey AS applicant, host FROM customer JOIN (SELECT DISTINCT host FROM web)
                         ON c_custkey % 7 = length(host) % 7 WHERE c_mktsegment = 'MACHINERY'),
        species AS (SELECT DISTINCT o_custkey AS applicant, term FROM orders JOIN dict_a ON o_orderkey % 3 + 5 = length(term))"""),
    "a76_funnel_stages": _q(
        """SELECT 1 AS stage_no, 'documents' AS stage, count(*) AS documents FROM f
           UNION ALL SELECT 2, 'common', count(*) FROM f WHERE a
           UNION ALL SELECT 3, 'product', count(*) FROM f WHERE a AND b
           UNION ALL SELECT 4, 'excluded', count(*) FROM f WHERE a AND b AND NOT c""", "dtok", "dict_a", "dict_b",
        extra="""f AS (SELECT doc_id, bool_or(w IN (SELECT term FROM dict_a WHERE label = 'COMMON')) AS a,
                       bool_or(w IN (SELECT term FROM dict_b)) AS b,
                       bool_or(w IN (SELECT term FROM dict_a WHERE label = 'TAXONOMIC' AND length(term) = 5)) AS c
                       FROM dtok GROUP BY doc_id)"""),
})

ORACLE.update({
    "a67_compile_places": _q(
        """SELECT place_id, suppliers, name, customers FROM (
               SELECT *, row_number() OVER (PARTITION BY place_id
                          ORDER BY filled DESC, src, suppliers DESC NULLS LAST, name DESC NULLS LAST,
                                   customers DESC NULLS LAST) AS rn
               FROM (SELECT s_nationkey AS place_id, count(*) AS suppliers, NULL::VARCHAR AS name,
                            NULL::BIGINT AS customers, 1 AS filled, 0 AS src
                     FROM supplier GROUP BY s_nationkey
                     UNION ALL
                     SELECT c_nationkey, NULL::BIGINT, n_name, count(*), 2, 1
                     FROM customer JOIN nation ON c_nationkey = n_nationkey
                     GROUP BY c_nationkey, n_name))
           WHERE rn = 1"""),
    "a68_separate_urls": _q(
        "SELECT split_part(url, '://', 1) AS scheme, count(*) AS n FROM pages GROUP BY 1"),
    "a69_missing_values": _q(
        """SELECT coalesce(label, 'none') AS label, count(*) AS n FROM seq GROUP BY 1
           UNION ALL
           SELECT '(kept after drop)', count(*) FROM seq WHERE label IS NOT NULL""", "seq"),
    "a70_reshape_parts": _q(
        "SELECT p_retailprice AS price, p_partkey AS id, p_name AS title FROM part"),
    "a71_graph_elements": _q(
        """SELECT 'node' AS kind, name, category, CAST(value AS DOUBLE) AS value, symbol_size, NULL AS source, NULL AS target FROM nodes
           UNION ALL SELECT 'link', NULL, NULL, NULL, NULL, item1, item2 FROM (
               SELECT DISTINCT item1, item2 FROM pairs
               WHERE item1 IN (SELECT name FROM nodes) AND item2 IN (SELECT name FROM nodes))
           UNION ALL SELECT 'category', category, NULL, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT category FROM nodes)""",
        "inst", extra=_INST_LINKS + "," + _INST_WORKS + "," + _INST_NODES),
    "a72_first_filings_by_country": _q(
        """SELECT f.first_year, g.country, g.section, count(*) AS families
           FROM (SELECT family_id, CAST(year(min(filing_date)) AS INTEGER) AS first_year FROM patents GROUP BY family_id) f
           JOIN (SELECT DISTINCT family_id, country, section FROM patents) g USING (family_id)
           GROUP BY 1, 2, 3""", "patents"),
    "a77_taxa_country_fields": _q(
        """SELECT l_partkey AS taxon, NOT bool_or(l_returnflag = 'R') AS marine_only, bool_or(l_partkey % 2 = 0) AS abnj,
                  bool_and(l_partkey % 2 = 0) AND NOT bool_or((l_linenumber = 7 AND l_returnflag IS NOT NULL)
                    OR (l_linenumber = 6 AND l_returnflag = 'N' AND l_linestatus IS NOT NULL)) AS abnj_only,
                  count(*) AS occurrences FROM lineitem GROUP BY l_partkey"""),
    "a78_unmatched_documents": _q("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"),
    "a79_listing_names": _q(
        """SELECT asin, title FROM listings
           WHERE list_has_any(string_split(lower(title), ' '), string_split(search_term, ' '))
              OR (asin % 2 = 0 AND list_has_any(string_split(lower(title), ' '), ['widget', 'large']))""", "listings"),
})


# ---- variants, phrases, lags, file order, types, hierarchies -------------------

def _words(text: str) -> str:
    """Lower-case words without the signs at their edges, as a list."""
    return (f"list_filter(list_transform(regexp_split_to_array(lower({text}), '[ \\t\\r\\n]+'), "
            "lambda x: regexp_replace(x, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')), lambda x: x <> '')")


_LAGS = """
        c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS p, CAST(year(l_shipdate) - year(o_orderdate) AS INTEGER) AS lag, count(*) AS n
              FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              WHERE l_shipdate >= o_orderdate AND year(l_shipdate) <= 2000 GROUP BY 1, 2),
        g AS (SELECT j, sum(n) AS al, coalesce(sum(n) FILTER (lag = j), 0) AS nw FROM c, range(0, (SELECT max(lag) + 1 FROM c)) AS r(j)
              WHERE lag <= j AND p + j <= 2000 GROUP BY j),
        y AS (SELECT p, CAST(sum(n) AS BIGINT) AS n, least(2000 - p, (SELECT max(lag) FROM c)) AS age FROM c GROUP BY p),
        z AS (SELECT p, n, CASE WHEN (SELECT coalesce(bool_or(al = nw), false) FROM g WHERE j > age) THEN 0.0
                     ELSE exp(coalesce((SELECT sum(ln(1.0 * (al - nw) / al)) FROM g WHERE j > age), 0.0)) END AS done FROM y),
        cliff AS (SELECT p AS year, n, round(done, 6) AS completeness, CASE WHEN done > 0 THEN round(n / done, 6) END AS estimated,
                         round(done, 6) >= 0.95 AS complete FROM z)"""

ORACLE.update({
    "a80_place_variants": _q(
        """SELECT cc.name, cc.root AS place_id, b.canonical FROM cc JOIN (
               SELECT root, arg_min(name, (-n, name)) AS canonical FROM (
                   SELECT cc.root, cc.name, count(*) AS n FROM cc JOIN recs ON recs.name = cc.name GROUP BY 1, 2) GROUP BY root) b ON b.root = cc.root""",
        extra=f"""
        said AS (SELECT CAST(doc_id AS VARCHAR) AS id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]+[ ]+|\n+'),
                        lambda s: array_to_string({_words('s')}, ' ')), lambda s: s <> '') AS l FROM documents),
        recs AS (SELECT id, l[1] AS name FROM said WHERE len(l) > 0 UNION SELECT id, l[-1] FROM said WHERE len(l) > 0),
        cc AS (WITH RECURSIVE r(name, root) USING KEY (name) AS (
                 SELECT name, min(id) FROM recs GROUP BY name
                 UNION
                 SELECT b.name, min(r.root) FROM r JOIN recs a ON a.name = r.name JOIN recs b ON b.id = a.id
                 JOIN recurring.r AS old ON old.name = b.name WHERE r.root < old.root GROUP BY b.name)
               SELECT name, root FROM r)"""),
    "a81_phrases_of_any_length": _q(
        """SELECT term, k AS size, count(*) AS occurrences, count(DISTINCT doc_id) AS documents FROM taken GROUP BY term, k""", "sents",
        extra=f"""
        bw AS (SELECT {_words('text')} AS ws FROM benchmark),
        d AS (SELECT DISTINCT ws[a:a + k - 1] AS tw, ws[a] AS first, array_to_string(ws[a:a + k - 1], ' ') AS term, CAST(k AS INTEGER) AS k
              FROM (SELECT ws, k, k * (k - 1) // 2 + 1 AS a FROM bw, range(1, 7) AS r(k)) WHERE len(ws) >= a + k - 1),
        sw AS (SELECT row_number() OVER () AS rid, doc_id, {_words('s')} AS ws FROM sents),
        m AS (SELECT rid, doc_id, i, d.term, d.k FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM sw) s
              JOIN d ON s.ws[s.i] = d.first AND s.ws[s.i:s.i + d.k - 1] = d.tw),
        best AS (SELECT rid, doc_id, i, max(k) AS k, arg_max(term, k) AS term FROM m GROUP BY rid, doc_id, i),
        nxt AS (SELECT b.*, n.i AS after FROM best b ASOF LEFT JOIN best n ON b.rid = n.rid AND b.i + b.k <= n.i),
        taken AS (WITH RECURSIVE t AS (
                    SELECT * FROM nxt QUALIFY row_number() OVER (PARTITION BY rid ORDER BY i) = 1
                    UNION ALL SELECT n.* FROM t JOIN nxt n ON n.rid = t.rid AND n.i = t.after)
                  SELECT * FROM t)"""),
    "a82_data_cliff": _q("SELECT * FROM cliff", extra=_LAGS),
    "a83_trend_of_complete_years": _q(
        """SELECT status, round(regr_slope(n, year), 6) AS slope, round(regr_intercept(n, year), 6) AS intercept
           FROM (SELECT year(o_orderdate) AS year, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2)
           JOIN cliff USING (year) WHERE completeness >= 0.5 GROUP BY status""".replace("n, year)", "CAST(x.n AS DOUBLE), CAST(year AS DOUBLE))")
        .replace("GROUP BY 1, 2)\n", "GROUP BY 1, 2) x\n"), extra=_LAGS),
    "a84_file_order": _q(
        """SELECT row_number() OVER (ORDER BY event_id) - 1 AS row_no, event_id, user_id,
                  last_value(label IGNORE NULLS) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM seq""", "seq"),
    "a85_inferred_types": """
        SELECT table_name, column_name, CASE WHEN data_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN 'bigint'
                 WHEN data_type IN ('FLOAT', 'DOUBLE') THEN 'double' WHEN data_type = 'DATE' THEN 'date' WHEN data_type = 'TIMESTAMP' THEN 'timestamp_ntz'
                 WHEN data_type = 'BOOLEAN' THEN 'boolean' ELSE 'string' END AS type
        FROM information_schema.columns WHERE data_type NOT LIKE '%[]' AND table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders',
          'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')""",
    "a86_plural_terms": _q(
        """SELECT canonical AS term, count(DISTINCT w) AS forms, count(DISTINCT doc_id) AS documents, count(*) AS occurrences
           FROM u JOIN (SELECT variant, canonical FROM best UNION SELECT canonical, canonical FROM best) k ON u.w = k.variant GROUP BY 1""",
        extra=f"""
        u AS (SELECT doc_id, unnest({_words('text')}) AS w FROM documents),
        v AS (SELECT DISTINCT w FROM u),
        e AS (SELECT * FROM (VALUES (0, 'ies', 'y'), (1, 'ches', 'ch'), (2, 'shes', 'sh'), (3, 'sses', 'ss'), (4, 'xes', 'x'), (5, 'zes', 'z'), (6, 's', '')) t(k, e, x)),
        tries AS (SELECT w AS variant, k, w[:len(w) - len(e)] || x AS canonical FROM v JOIN e ON ends_with(w, e)
                  WHERE NOT (ends_with(w, 'ss') OR ends_with(w, 'us') OR ends_with(w, 'is'))),
        best AS (SELECT variant, canonical FROM tries WHERE len(canonical) >= 3 AND canonical IN (SELECT w FROM v)
                 QUALIFY row_number() OVER (PARTITION BY variant ORDER BY k) = 1)"""),
    "a87_ancestor_counts": _q(
        """SELECT coalesce(a.term, o.term) AS term, coalesce(own, 0) AS own, orders FROM
             (SELECT anc AS term, count(DISTINCT l_orderkey) AS orders FROM lineitem JOIN up ON l_partkey = node GROUP BY 1) a
             LEFT JOIN (SELECT l_partkey AS term, count(DISTINCT l_orderkey) AS own FROM lineitem GROUP BY 1) o ON a.term = o.term""",
        extra="""
        up AS (WITH RECURSIVE r AS (
                 SELECT DISTINCT l_partkey AS node, l_partkey AS anc FROM lineitem
                 UNION SELECT r.node, CAST(p_partkey // 4 AS BIGINT) FROM r JOIN part ON r.anc = p_partkey WHERE p_partkey <> p_partkey // 4)
               SELECT * FROM r)"""),
    "a88_compare_works": _q(
        """SELECT membership, count(DISTINCT w) AS terms, count(DISTINCT doc_id) AS works FROM (
               SELECT CASE WHEN in_en AND in_de THEN 'both' WHEN in_en THEN 'en_only' ELSE 'de_only' END AS membership, w, t.doc_id
               FROM flags JOIN dtok t USING (w) JOIN documents d ON d.doc_id = t.doc_id WHERE d.lang IN ('en', 'de')) GROUP BY membership""", "dtok", extra=_VOCAB),
    "a89_stored_sketches": _q(
        """SELECT kind, membership, CAST(exact AS BIGINT) AS exact, true AS within FROM (
             SELECT kind, unnest(['both', 'en_only', 'de_only', 'either']) AS membership,
                    unnest([count(*) FILTER (a AND b), count(*) FILTER (a AND NOT b), count(*) FILTER (b AND NOT a), count(*)]) AS exact
             FROM (SELECT 'terms' AS kind, in_en AS a, in_de AS b FROM flags
                   UNION ALL SELECT 'works', bool_or(lang = 'en'), bool_or(lang = 'de') FROM documents
                   WHERE lang IN ('en', 'de') AND doc_id IN (SELECT doc_id FROM dtok) GROUP BY doc_id) GROUP BY kind)""", "dtok", extra=_VOCAB),
    "a90_parsed_names": _q(
        """SELECT kind, hybrid, qualifier, rank, moved, count(*) AS names, count(DISTINCT genus) AS genera, count(DISTINCT subgenus) AS subgenera,
                  count(DISTINCT epithet) AS epithets, count(DISTINCT infra) AS infras, count(DISTINCT authority) AS authorities, count(DISTINCT year) AS years
           FROM parsed GROUP BY 1, 2, 3, 4, 5""", "sents",
        extra=r"""
        made AS (SELECT upper(split_part(p_name, ' ', 1)[1]) || split_part(p_name, ' ', 1)[2:] AS a, split_part(p_name, ' ', 2) AS b, lower(p_type) AS ty,
                        upper(p_type[1]) || lower(p_type[2:]) AS ity, regexp_replace(p_brand, '[^A-Za-z]', '', 'g') AS au, CAST(p_size + 1750 AS VARCHAR) AS yr, p_partkey % 8 AS f, p_name FROM part),
        raws AS (SELECT CASE f WHEN 0 THEN a || ' ' || b WHEN 1 THEN a || ' ' || b || ' (' || au || ', ' || yr || ')' WHEN 2 THEN a || ' (' || ity || ') ' || b || ' ' || au || ', ' || yr
                        WHEN 3 THEN a || ' cf. ' || b WHEN 4 THEN a || ' ' || b || ' var. ' || ty || ' ' || au WHEN 5 THEN '× ' || a || ' ' || b WHEN 6 THEN a || ' sp. ' || yr ELSE p_name END AS name FROM made
                 UNION ALL SELECT array_to_string(list_filter(string_split(s, ' '), lambda w: w <> '')[1:3], ' ') FROM sents),
        norm AS (SELECT array_to_string(list_filter(regexp_split_to_array(replace(name, '×', '× '), '[ \t\r\n]+'), lambda w: w <> ''), ' ') AS name FROM raws),
        w AS (SELECT name, string_split(name, ' ') AS w FROM norm),
        h AS (SELECT w[1] IN ('×', 'x', 'X') AS hybrid, CASE WHEN w[1] IN ('×', 'x', 'X') THEN w[2:] ELSE w END AS w FROM w),
        g AS (SELECT hybrid, w[1] AS genus, w[2:] AS w FROM h WHERE regexp_matches(w[1], '^\p{Lu}[\p{Ll}-]+$')),
        s AS (SELECT hybrid, genus, CASE WHEN regexp_matches(w[1], '^\(\p{Lu}[\p{Ll}-]+\)$') THEN w[1][2:-2] END AS subgenus,
                     CASE WHEN regexp_matches(w[1], '^\(\p{Lu}[\p{Ll}-]+\)$') THEN w[2:] ELSE w END AS w FROM g),
        q AS (SELECT hybrid, genus, subgenus, CASE WHEN w[1] IN ('sp.', 'spp.', 'sp', 'spp', 'cf.', 'aff.', 'nr.') THEN w[1] END AS qualifier,
                     CASE WHEN w[1] IN ('sp.', 'spp.', 'sp', 'spp', 'cf.', 'aff.', 'nr.') THEN w[2:] ELSE w END AS w FROM s),
        e AS (SELECT * EXCLUDE (w), CASE WHEN low THEN w[1] END AS epithet, CASE WHEN low THEN w[2:] ELSE w END AS w
              FROM (SELECT *, coalesce(NOT starts_with(qualifier, 'sp'), true) AND LOWER_WORD(w[1]) AS low FROM q)),
        i AS (SELECT * EXCLUDE (w), CASE WHEN epithet IS NOT NULL AND w[1] IN ('subsp.', 'ssp.', 'var.', 'subvar.', 'f.', 'forma', 'subf.') THEN w[1] END AS rank,
                     CASE WHEN epithet IS NOT NULL AND w[1] IN ('subsp.', 'ssp.', 'var.', 'subvar.', 'f.', 'forma', 'subf.') THEN w[2:] ELSE w END AS w FROM e),
        j AS (SELECT * EXCLUDE (w), CASE WHEN epithet IS NOT NULL AND LOWER_WORD(w[1]) THEN w[1] END AS infra,
                     CASE WHEN epithet IS NOT NULL AND LOWER_WORD(w[1]) THEN w[2:] ELSE w END AS w FROM i),
        k AS (SELECT *, list_position(list_transform(w, lambda x: regexp_matches(x, '^\(?[12][0-9]{3}[a-z]?\)?,?$')), true) AS pos FROM j),
        l AS (SELECT *, CASE WHEN pos IS NOT NULL THEN translate(w[pos], '(),', '') END AS year,
                     array_to_string(CASE WHEN pos IS NOT NULL THEN w[:pos - 1] ELSE w END, ' ') AS au, pos IS NOT NULL AND pos < len(w) AS more FROM k),
        whole AS (SELECT CASE WHEN qualifier IS NOT NULL THEN 'open' WHEN infra IS NOT NULL THEN 'trinomial' WHEN epithet IS NOT NULL THEN 'binomial' ELSE 'uninomial' END AS kind,
                         hybrid, qualifier, rank, starts_with(au, '(') AS moved, genus, subgenus, epithet, infra,
                         nullif(regexp_replace(translate(au, '()', ''), '[ ,]+$', ''), '') AS authority, year FROM l WHERE NOT more AND (rank IS NULL OR infra IS NOT NULL)),
        parsed AS (SELECT * FROM whole UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
                   FROM range(0, (SELECT count(*) FROM norm) - (SELECT count(*) FROM whole)))"""),
    "a91_rank_habitats": """
        SELECT rank, count(*) AS taxa, count(*) FILTER (marine) AS marine, count(*) FILTER (brackish) AS brackish, count(*) FILTER (freshwater) AS freshwater,
               count(*) FILTER (terrestrial) AS terrestrial, count(*) FILTER (marine AND NOT brackish AND NOT freshwater AND NOT terrestrial) AS marine_only
        FROM (SELECT p_type AS rank, l_partkey, bool_or(l_returnflag = 'N') AS marine, bool_or(l_linenumber = 7 AND l_returnflag = 'R') AS brackish,
                     bool_or(l_linenumber = 6 AND l_returnflag = 'A') AS freshwater, bool_or(l_quantity > 49) AS terrestrial
              FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY rank""",
    "a92_csv_round_trip": "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents",
    "a93_delimited_round_trip": "SELECT *, CASE WHEN event_id % 5 = 0 THEN event_type END AS label FROM events",
    "a94_json_corpus_round_trip": "SELECT url, md5(html) AS text_md5 FROM pages",
    "a95_partitioned_round_trip": "SELECT lang, source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1, 2",
})
ORACLE["a90_parsed_names"] = re.sub(
    r"LOWER_WORD\(([^()]*)\)",
    r"(coalesce(regexp_matches(\1, '^[\\p{Ll}][\\p{Ll}-]+$') AND \1 NOT IN ('de', 'da', 'di', 'du', 'van', 'von', 'der', 'den', 'la', 'le', 'ex', 'et', 'in', "
    r"'sp', 'spp', 'forma'), false))", ORACLE["a90_parsed_names"])
ORACLE["a96_graph_files"] = ORACLE["a71_graph_elements"]
