"""Pages that name an applicant's own species, as rows and as bits."""

from collections import defaultdict

import pytest

from tidepool.operators import listings

# More terms than bits of a block, so that blocks are many, full and partly filled.
TERMS = [f"t{i}" for i in range(3 * listings.BLOCK + 5)]


def links(spark):
    """Applicants with several domains, repeated and null links, a domain with too few pages, terms on no page."""
    applicants = [(a, f"h{h}") for a in range(12) for h in range(6) if (a * 5 + h) % 3] * 2 + [(None, "h0"), (1, None), (99, "h1"), (3, "h9")]
    species = [(a, TERMS[i]) for a in range(12) for i in range(len(TERMS)) if (a * 7 + i * 3) % 5 < 2 or i % 64 == 63] * 2
    species += [(None, "t1"), (2, None), (98, "t2"), (4, "nowhere")]
    pages = [(h * 10 + p, f"h{h}", " ".join(t.upper() + "," for i, t in enumerate(TERMS) if (i + h * p) % 4 < 2 or i % 64 == 63) + " t1 t1")
             for h in range(5) for p in range(4)] + [(90 + p, "h5", "t1 t2 t3") for p in range(2)] + [(95, "h0", None), (96, None, "t1"), (97, "h1", "")]
    return (applicants, species, pages), (
        spark.createDataFrame(applicants, "applicant long, host string"), spark.createDataFrame(species, "applicant long, term string"),
        spark.createDataFrame(pages, "page_id long, host string, text string"))


def plain(applicants, species, pages) -> set:
    ids, on = defaultdict(set), defaultdict(set)
    for page, host, text in pages:
        ids[host].add(page)
        for w in (text or "").split():
            on[host, w.strip(",").lower()].add(page)
    return {(a, h, t, len(on[h, t])) for a, h in applicants for b, t in species
            if a is not None and a == b and h is not None and len(ids[h]) >= 3 and on.get((h, t))}


def test_applicant_species_pages_as_rows(spark):
    given, frames = links(spark)
    got = [tuple(r) for r in listings.applicant_species_pages(*frames).collect()]
    want = plain(*given)
    assert len(got) == len(want) and set(got) == want


def test_packed_hits_hold_every_hit_in_a_row_for_a_block(spark):
    given, frames = links(spark)
    packed, want = listings.applicant_species_pages(*frames, packed=True), plain(*given)
    assert packed.hits.count() <= len({(a, h) for a, h, _, _ in want}) * 4 < len(want) / 10
    assert sum(bin(r["_bits"] & (2**64 - 1)).count("1") for r in packed.hits.collect()) == len(want)
    assert {tuple(r) for r in packed.rows().collect()} == want
    totals = {r.term: (r.applicants, r.domains, r.most_pages) for r in packed.totals().collect()}
    for term in {t for _, _, t, _ in want}:
        a, h, n = zip(*((a, h, n) for a, h, t, n in want if t == term))
        assert totals.pop(term) == (len(set(a)), len(set(h)), max(n)), term
    assert totals == {}


def test_terms_are_dealt_into_blocks_without_a_place_twice(spark, monkeypatch):
    monkeypatch.setattr(listings, "NUMBERED", 50)
    rows = listings.term_blocks(spark.createDataFrame([(t,) for t in TERMS * 2], "term string")).collect()
    assert sorted(r.term for r in rows) == sorted(TERMS) and len({(r["_block"], r["_bit"]) for r in rows}) == len(TERMS)
    assert all(0 <= r["_bit"] < listings.BLOCK for r in rows)


@pytest.mark.parametrize("empty", range(3))
def test_no_links_or_pages_give_no_hits(spark, empty):
    frames = [f.limit(0) if i == empty else f for i, f in enumerate(links(spark)[1])]
    packed = listings.applicant_species_pages(*frames, packed=True)
    assert packed.rows().count() == 0 and packed.totals().count() == 0
