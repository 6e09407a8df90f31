"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles; documents with equal sets
are one class, and classes link when their Jaccard similarity reaches the
threshold. Shingles have one global order, by estimated frequency (a bounded
table of counts over all documents) and then by hash, so that rare ones come
first. If two sets link, their prefixes share a shingle; if both prefixes are
longer by l - 1, they share l. A set lengthens its prefix by the l that has the
least estimated cost, reading the lists of its prefix plus verifying what
shares enough of them, and a pair needs the smaller l of the two.

No group of similar documents is expanded into all its pairs:

1. In each list the set with the fewest shingles of its own leads, and the
   others are verified against it alone, which finds most links.
2. Sets that were verified against one leader differ from it by few shingles;
   two of them link exactly if they share enough of these differences. Those
   are joined by a prefix of their differences, rarest first.
3. Pairs that are left, in different components and without a common leader,
   are generated from the prefixes and verified. In a list, only the sets
   outside its largest component look for partners.

Before any text is shuffled for a pair, bits of the shingles of both sides (some
two to four for each shingle) rule out most pairs that are far from similar.
Every pair that could link two components is verified or excluded by a bound,
so the components are exact; the links inside a component are not all listed.

Defined results: a text that is NULL or has no words has an empty set and links
with nothing; fewer words than a shingle are one shingle; repeated rows are one
class; a NULL id is in its class but never names a component unless it is alone
there (the component is then NULL); an empty table gives no rows; only the
named columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm import hashing
from tidepool.llm.bitmaps import bitmap_of
from tidepool.llm.common import bare, free, fresh, settled, slices
from tidepool.llm.graphs import components
from tidepool.llm.repeats import documents

BITS = 16
#: Bytes of text whose shingles are made at once, about; a worker holds some 45 bytes of working tables for each.
SLICE = 1 << 20
SETS = "id long, h long, n int, s1 long, s2 long, need int, head int, prefix array<long>"
PAIRS = "x long, y long, nx int, ny int, both int, differ array<long>"


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, in order; A-Z count as a-z."""
    data, offsets = hashing.text_bytes(texts)
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, ends, at = hashing.word_spans(data, offsets)
    sums = hashing.prefix_sums(hashing.word_hashes(data, starts, ends))
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        first = np.arange(a, max(a + 1, b - size + 1)) if b > a else np.zeros(0, dtype=np.int64)
        out.append(np.unique(hashing.span_hashes(sums, first, np.minimum(first + size, b))))
    return out


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> hashing.U(64 - BITS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << BITS, dtype=np.int64)
    for batch in batches:
        for part in slices(batch, 0, SLICE):
            for s in shingle_sets(part.column(0), size):
                total += np.bincount(_bucket(s), minlength=1 << BITS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])


def _prefix(s: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[int, int, np.ndarray]:
    """(needed matches, length as the smaller set, prefix as the larger set) of a set."""
    n = len(s)
    often = counts[_bucket(s)]
    order = np.lexsort((s, often))
    whole, half = n - (-(-percent * n // 100)), n - (-(-2 * percent * n // (100 + percent)))
    lists = np.cumsum(np.maximum(0.0, often[order] - usual) + 1.0)
    # Reading the lists of the prefix, and verifying what may share l of them: a candidate costs as much as eight entries.
    cost = [lists[min(n, whole + k) - 1] * (1 + 8 / k) for k in range(1, 5)]
    k = min(int(np.argmin(cost)) + 1, n)
    return k, min(n, half + k), s[order[: min(n, whole + k)]]


def _sets(batches: Iterator[pa.RecordBatch], shared, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    counts = shared.value
    usual = float(np.median(counts))
    for batch in batches:
        for part in slices(batch, 2, SLICE):
            rows = []
            for s in shingle_sets(part.column(2), size):
                if len(s):
                    k, head, prefix = _prefix(s, counts, usual, percent)
                    sums = np.add.reduce(hashing.mix(s)), np.add.reduce(hashing.mix(s ^ hashing.U(0x5851F42D4C957F2D)))
                    rows.append((len(s), *(int(x.view(np.int64)) for x in sums), k, head, prefix.view(np.int64)))
                else:
                    rows.append((0, 0, 0, 0, 0, np.zeros(0, dtype=np.int64)))
            if rows:
                n, s1, s2, need, head, prefix = zip(*rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int32()), pa.array(s1), pa.array(s2), pa.array(need, pa.int32()),
                                                  pa.array(head, pa.int32()), pa.array(prefix, pa.list_(pa.int64()))], [x.split()[0] for x in SETS.split(", ")])


def _verified(batches: Iterator[pa.RecordBatch], size: int, near: int) -> Iterator[pa.RecordBatch]:
    """Sizes and intersection of each pair of texts, and their symmetric difference if ``near`` percent similar."""
    for batch in batches:
        for part in slices(batch, 2, SLICE):
            rows = []
            for x, y, s, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                  shingle_sets(part.column(2), size), shingle_sets(part.column(3), size)):
                both = len(np.intersect1d(s, t, assume_unique=True))
                close = 100 * both >= near * (len(s) + len(t) - both)
                rows.append((x, y, len(s), len(t), both, np.setxor1d(s, t, assume_unique=True).view(np.int64) if close else None))
            if rows:
                x, y, nx, ny, both, differ = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), *(pa.array(v, pa.int32()) for v in (nx, ny, both)),
                                                  pa.array(differ, pa.list_(pa.int64()))], [v.split()[0] for v in PAIRS.split(", ")])


def marks(texts: pa.Array, size: int) -> list[bytes]:
    """A bit for each shingle of each text, in a power of two of bits, two to four times as many as shingles."""
    out = []
    for s in shingle_sets(texts, size):
        bits = np.zeros(1 << max(6, (2 * len(s) - 1).bit_length()), dtype=bool)
        bits[s & hashing.U(len(bits) - 1)] = True
        out.append(np.packbits(bits).tobytes())
    return out


def most_shared(nx: int, ny: int, mx: bytes, my: bytes) -> int:
    """As many shingles as two sets of nx and ny can share: a bit of one that the other lacks is at least one shingle that it lacks."""
    a, b = np.frombuffer(mx, np.uint8), np.frombuffer(my, np.uint8)
    short = min(len(a), len(b))
    a, b = np.bitwise_or.reduce(a.reshape(-1, short)), np.bitwise_or.reduce(b.reshape(-1, short))
    return min(nx - int(np.bitwise_count(a & ~b).sum()), ny - int(np.bitwise_count(b & ~a).sum()))


def _held(batches: Iterator[pa.RecordBatch], bitmap, size: int) -> Iterator[pa.RecordBatch]:
    """The rows (print, id, h, text) whose print may be in the bitmap; with ``size``, the marks of their shingles instead of texts."""
    for batch in batches:
        held = batch.filter(pa.array(bitmap.value.may_hold(batch.column(0).to_numpy().view(hashing.U))))
        if not size:
            yield held
            continue
        for part in slices(held, 3, SLICE):
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(marks(part.column(3), size), pa.binary())], ["print", "id", "h", "value"])


def _of_classes(pairs: DataFrame, docs: DataFrame, place: DataFrame, size: int = 0) -> DataFrame:
    """(cls, n, value) of the classes in ``pairs``, the text as value or, with ``size``, its marks: only theirs are shuffled, once each."""
    ids = pairs.select(F.col("x").alias("cls")).unionAll(pairs.select("y")).distinct()
    need = settled(place.join(ids, "cls", "left_semi").withColumn("print", F.xxhash64("of", "oh")), "needed")
    kind = "binary" if size else "string"
    bitmap = bitmap_of(need.select("print"))
    if bitmap is None:
        met = need.select("cls", "n", F.lit(None).cast(kind).alias("value"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(bitmap)
        some = docs.select(F.xxhash64("id", "h").alias("print"), "id", "h", F.col("text").alias("value")).mapInArrow(
            lambda it: _held(it, shared, size), f"print long, id long, h long, value {kind}")
        met = some.join(need, "print").filter(F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("oh")))
        met = met.groupBy("print", "cls", "n").agg(F.min("value").alias("value")).drop("print")
    met = settled(met, "set-marks" if size else "set-texts")
    free(need)
    return met


def _sides(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """(x, y, nx, ny, vx, vy): the pairs with the sizes and values of both sides."""
    def side(c: str) -> DataFrame:
        return values.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("value").alias(f"v{c}"))
    return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "nx", "ny", "vx", "vy")


def _possible(batches: Iterator[pa.RecordBatch], near: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose marks do not rule out that they are ``near`` percent similar."""
    for batch in batches:
        x, y, nx, ny, vx, vy = (batch.column(k).to_pylist() for k in range(6))
        most = [most_shared(*v) for v in zip(nx, ny, vx, vy)]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["x", "y"]).filter(
            pa.array([100 * m >= near * (a + b - m) for m, a, b in zip(most, nx, ny)], pa.bool_()))


def _verify(pairs: DataFrame, docs: DataFrame, place: DataFrame, size: int, percent: int, near: int) -> DataFrame:
    """What ``_verified`` says of the pairs that may be ``percent`` or ``near`` percent similar, whichever is less."""
    least = min(percent, near)
    listed = settled(pairs, "pairs")
    signs = _of_classes(listed, docs, place, size)
    pairs = settled(_sides(listed, signs).mapInArrow(lambda it: _possible(it, least), "x long, y long"), "possible")
    free(listed, signs)
    texts = _of_classes(pairs, docs, place)
    both = _sides(pairs, texts).select("x", "y", "vx", "vy")
    verified = settled(both.mapInArrow(lambda it: _verified(it, size, near), PAIRS), "verified")
    free(pairs, texts)
    return verified


def similar(both: Column, nx: Column, ny: Column, percent: int) -> Column:
    return 100 * both >= percent * (nx + ny - both)


def _parts(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, part): the component of every class, itself where it has no link."""
    found = components(links).withColumnRenamed("node", "cls")
    return classes.select("cls").join(found, "cls", "left").select("cls", F.coalesce("component", "cls").alias("part"))


def _leaders(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of each set and the leader of each of its lists, if their sizes allow a link."""
    lead = shared.groupBy("token").agg(F.min(F.struct("own", "cls", "n")).alias("lead")).select(
        "token", F.col("lead.cls").alias("y"), F.col("lead.n").alias("ny"))
    pairs = shared.join(lead, "token").filter((F.col("cls") != F.col("y")) & (100 * F.least("n", "ny") >= percent * F.greatest("n", "ny")))
    return pairs.select(F.col("cls").alias("x"), "y").distinct()


def _by_difference(known: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) between sets with a common leader, from what each differs from it by; ``known``: verified pairs (set x, leader y)."""
    # Sets of sizes nx, ny link if their symmetric difference is at most (nx + ny) * slack.
    slack = (100 - percent) / (100 + percent)
    own = known.filter("differ is not null").join(parts.withColumnRenamed("cls", "x"), "x").select(
        "x", F.col("y").alias("lead"), "nx", "ny", "part", "differ", similar(F.col("both"), F.col("nx"), F.col("ny"), percent).alias("linked"))
    d = F.size("differ")
    # At least so many differences are shared with any partner of which one side does not link with the leader.
    least = F.when(F.col("linked"), d + slack * (F.col("ny") - F.col("nx"))).otherwise(d - slack * (F.col("nx") + F.col("ny")))
    own = own.withColumn("least", F.greatest(F.lit(1), F.ceil(least / 2 - 1e-6)).cast("int"))
    spread = own.select("x", "lead", F.explode("differ").alias("token"))
    often = settled(spread.groupBy("lead", "token").agg(F.count("*").alias("often")).filter("often > 1"), "differences")
    listed = spread.join(often, ["lead", "token"]).groupBy("x", "lead").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("common"))
    # The rarest come first: those that no other set has, then the rest in their order.
    length = F.size("differ") - F.col("least") + 1 - (F.size("differ") - F.size("common"))
    heads = own.join(listed, ["x", "lead"]).withColumn("length", length).filter("length > 0")
    heads = settled(heads.select("x", "lead", "part", "linked", "nx", d.alias("d"), F.size("common").alias("c"), F.posexplode(
        F.slice("common", F.lit(1), F.col("length"))["token"]).alias("at", "token")), "difference-heads")
    free(often)
    a, b = heads.alias("a"), heads.alias("b")
    sides = (F.col("a.part") != F.col("b.part")) & ~F.col("a.linked") & (F.col("b.linked") | (F.col("a.x") < F.col("b.x")))
    # So many differences are shared if the two link; at most this one and what stands before and behind it in both orders are.
    wanted = (F.col("a.d") + F.col("b.d") - slack * (F.col("a.nx") + F.col("b.nx"))) / 2 - 1e-6
    room = F.least("a.at", "b.at") + 1 + F.least(F.col("a.c") - F.col("a.at"), F.col("b.c") - F.col("b.at")) - 1
    pairs = a.join(b, ["lead", "token"]).filter(sides & (room >= wanted)).select(
        "lead", F.col("a.x").alias("x"), F.col("b.x").alias("y")).distinct()
    sets = own.select("lead", "x", "nx", "differ")
    full = pairs.join(sets.select("lead", "x", F.col("nx").alias("n1"), F.col("differ").alias("d1")), ["lead", "x"]).join(
        sets.select("lead", F.col("x").alias("y"), F.col("nx").alias("n2"), F.col("differ").alias("d2")), ["lead", "y"])
    apart = F.size("d1") + F.size("d2") - 2 * F.size(F.array_intersect("d1", "d2"))
    both = ((F.col("n1") + F.col("n2") - apart) / 2).cast("int")
    links = settled(full.filter(similar(both, F.col("n1"), F.col("n2"), percent)).select("x", "y"), "links")
    free(heads)
    return links


def _left_over(shared: DataFrame, parts: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) in different components that share enough of their prefixes and have no common leader."""
    with_lead = known.filter("differ is not null").select("x", "y").unionAll(known.select(F.col("y").alias("x"), "y")).distinct()
    leads = with_lead.groupBy("x").agg(F.collect_set("y").alias("leads")).withColumnRenamed("x", "cls")
    rows = shared.join(parts, "cls").join(leads, "cls", "left").withColumn("leads", F.coalesce("leads", F.array().cast("array<long>")))
    rows = settled(rows, "lists")
    sizes = rows.groupBy("token", "part").agg(F.count("*").alias("size"))
    main = sizes.groupBy("token").agg(F.count("*").alias("parts"), F.max(F.struct("size", "part"))["part"].alias("main"))
    main = settled(main.filter("parts > 1").drop("parts"), "mixed-lists")
    rows = rows.join(main, "token")
    few = rows.filter("part <> main").select("token", *(F.col(c).alias(f"{c}1") for c in ("cls", "n", "need", "head", "pos", "part", "leads")))
    order = F.struct("n1", "cls1") < F.struct("n", "cls")
    join = (F.col("part1") != F.col("part")) & ((F.col("part") == F.col("main")) | (F.col("cls1") < F.col("cls")))
    fits = 100 * F.least("n1", "n") >= percent * F.greatest("n1", "n")
    inside = F.when(order, F.col("pos1") < F.col("head1")).otherwise(F.col("pos") < F.col("head"))
    # What is shared: this and what stands before and behind it in both orders.
    room = 1 + F.least("pos1", "pos") + F.least(F.col("n1") - F.col("pos1"), F.col("n") - F.col("pos")) - 1
    enough = room * (100 + percent) >= percent * (F.col("n1") + F.col("n"))
    apart = ~F.arrays_overlap("leads1", "leads")  # others are decided by their differences from a common leader
    pairs = rows.join(few, "token").filter(join & fits & apart & inside & enough)
    # Which side comes first differs from list to list, so that a pair is named by its smaller class.
    pairs = pairs.select(F.least("cls1", "cls").alias("x"), F.greatest("cls1", "cls").alias("y"), F.least("need1", "need").alias("need"))
    pairs = pairs.groupBy("x", "y").agg(F.count("*").alias("shared"), F.first("need").alias("need"))
    return pairs.filter(F.col("shared") >= F.col("need")).select("x", "y")


def _joined(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, h, n, component_id, place): the component of every row of (id, h, text), and the place that stands for it."""
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for r in docs.select("text").mapInArrow(lambda it: _counts(it, size), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]  # a table of 2**BITS counts
    frequent = docs.sparkSession.sparkContext.broadcast(counts)
    sets = settled(docs.mapInArrow(lambda it: _sets(it, frequent, size, percent), SETS), "sets")
    classes = sets.filter("n > 0").groupBy("s1", "s2", "n").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("place"), F.min("id").alias("doc"), *(F.first(c).alias(c) for c in ("need", "head", "prefix")))
    whole = settled(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    # Prefixes are the larger part of both tables; what follows needs them once.
    classes, names = settled(whole.drop("need", "head", "prefix"), "classes"), settled(sets.select("id", "h", "n", "s1", "s2"), "names")
    free(sets)

    lists = whole.select("cls", "n", "need", "head", F.size("prefix").alias("whole"), F.posexplode("prefix").alias("pos", "token"))
    tokens = settled(lists.groupBy("token").agg(F.count("*").alias("often")).filter("often > 1").select("token"), "tokens")
    first = settled(lists.join(tokens, "token"), "shared")
    free(whole, tokens)
    shared = first
    lone = shared.groupBy("cls").agg(((F.first("whole") - F.count("*")) / F.first("n")).alias("own"))
    shared = settled(shared.drop("whole").join(lone, "cls"), "shared")
    free(first)
    lone = shared.select("cls").distinct()
    place = classes.join(lone, "cls", "left_semi").select("cls", "n", F.col("place.id").alias("of"), F.col("place.h").alias("oh"))

    def links(verified: DataFrame) -> DataFrame:
        return verified.filter(similar(F.col("both"), F.col("nx"), F.col("ny"), percent)).select("x", "y")

    known = _verify(_leaders(shared, percent), docs, place, size, percent, percent // 2)
    found = links(known)
    found = found.unionAll(_by_difference(known, settled(_parts(found, classes), "parts"), percent))
    left = _verify(_left_over(shared, settled(_parts(found, classes), "parts"), known, percent), docs, place, size, percent, 101)
    free(shared)
    parts = settled(_parts(found.unionAll(links(left)), classes), "parts")
    of = classes.join(parts, "cls")
    parts_of = of.groupBy("part").agg(F.min("doc").alias("component_id"), F.min("place").alias("first"))
    named = of.join(parts_of, "part").select("s1", "s2", "n", "component_id", "first")
    return names.join(named, ["s1", "s2", "n"], "left")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``df``: id, n_shingles and component_id, the smallest id that links lead to."""
    return _joined(documents(df, id_col, text), size, percent).select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each component, that of its smallest id; rows without words all stay."""
    found = _joined(documents(df, id_col, text), size, percent)
    stays = found.filter(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("h") == F.col("first.h")) & (F.col("n") > 0))
    # Two hashes, never NULL, stand for the id and the text, so that one shuffle of the texts serves the join and the repeated rows.
    key, hashed = fresh(df, "key"), fresh(df, "hashed")
    stays = stays.select(F.xxhash64("id", "h").alias(key), F.col("h").alias(hashed)).distinct()
    rows = df.withColumn(hashed, F.xxhash64(F.col(text))).withColumn(key, F.xxhash64(F.col(id_col).cast("long"), F.col(hashed)))
    wordy = F.length(bare(F.col(text))) > 0
    kept = rows.filter(wordy).join(stays, [key, hashed], "left_semi")
    return kept.dropDuplicates([key, hashed]).unionByName(rows.filter(~wordy)).drop(key, hashed)
