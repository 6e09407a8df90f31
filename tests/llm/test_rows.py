"""Operators whose results are rows of counts: line rules, top-k, chat, mixing, packing."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.util import WORD, awkward_docs, clashing, frame, rows_of
from tidepool.llm import chat, lines, mixing, packing, topk
from tidepool.llm.tokens import WordTokenizer

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_line_rules(rows, min_docs, share):
    texts = [r[1] or "" for r in rows]
    norm = lambda x: " ".join(WORD.findall(x)).lower()
    first, docs, hosts = set(), Counter(), Counter()
    for r in rows:
        if (r[3], r[1]) not in first:
            first.add((r[3], r[1]))
            hosts[r[3]] += 1
            docs.update({(r[3], norm(x)) for x in (r[1] or "").split("\n") if WORD.search(x)})
    out = []
    for r, t in zip(rows, texts):
        w, held = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        again = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        lost = sum(len(WORD.findall(x)) for x in held if docs[r[3], norm(x)] > min_docs and docs[r[3], norm(x)] > share * hosts[r[3]])
        left = len(w) - lost
        out.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(held) - len(set(held)), len(again),
                    failed, not failed and left >= 10 and left >= 0.33 * len(w), lost))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_docs,share", [(1, 0.0), (3, 0.2), (20, 0.05)])
def test_line_rules_match_a_plain_version(spark, min_docs, share):
    got = lines.line_rules(clashing(frame(spark)), min_docs=min_docs, share=share)
    assert rows_of(got) == plain_line_rules(awkward_docs(), min_docs, share)


def test_line_rules_of_nothing(spark):
    assert lines.line_rules(frame(spark, [])).count() == 0


def test_a_line_in_many_documents_goes_on_a_hot_host_too(spark):
    boiler, own = "the same notice stands at the end of many pages here", "this page has words of its own number {} and some more of them to be kept"
    rows = [(i, own.format(i) + ("\n" + boiler if i < 60 else ""), "en", "hot", 0) for i in range(3000)]
    rows += [(9000 + i, own.format(i) + ("\n" + boiler if i < 10 else ""), "en", "small", 0) for i in range(100)]
    gone = lambda **kw: {r["doc_id"] for r in lines.line_rules(frame(spark, rows), **kw).filter("n_frequent_words > 0").collect()}
    assert gone(most_docs=50) == set(range(60))             # 60 of 3,000 documents: above the number, below the share
    assert gone(most_docs=60) == set()                      # neither above the number nor the share
    assert gone(most_docs=1000, min_docs=5) == set(range(9000, 9010))  # a tenth of a small host: above the share


def plain_top_k(rows, k, scale):
    vecs = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in vecs:
        if i % 3 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        found = sorted((-sum(a * b for a, b in zip(v, u)), i) for i, u in vecs if i != q and len(u) == len(v))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out, key=repr)


def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(150)]
    rows += [(200 + i, [0.5, -0.25, 0.125, 1.0, 0.0, 2.0]) for i in range(90)]  # ties
    rows += [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [math.nan] * 6), (304, [math.inf] * 6), (None, [1.0] * 6),
             (306, [1.0, 2.0]), (309, [2.0, 1.0]), (312, [1e6] * 6), rows[5], rows[6], (6, [9.0] * 6)]
    return rows


@pytest.mark.parametrize("block_bytes", [8 << 20, 40_000])
def test_top_k_matches_a_plain_version(spark, block_bytes):
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))
    got = topk.exact_top_k(df, F.col("vec_id") % 3 == 0, k=4, block_bytes=block_bytes, settle=4)
    assert rows_of(got) == plain_top_k(vectors(), 4, 256)


def test_top_k_of_nothing_and_of_too_large_numbers(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(empty, F.col("vec_id") % 3 == 0).count() == 0
    huge = spark.createDataFrame([(0, [2.0**40] * 2), (1, [2.0**40] * 2)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        topk.exact_top_k(huge, F.col("vec_id") % 3 == 0).collect()


CHATS = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a <\\s> \\ <<\\\\SYS>> <<SYS>>"), (2, 0, "tool", " [/ROLE]\n"), (2, 1, None, None),
         (2, 2, "[ROLE]x", "[:ROLE]"), (3, 5, "system", "s"), (3, 7, "user", ""), (3, 9, "assistant", "[\\INST] \U0001f600"), (3, None, "user", "first"),
         (None, None, "user", "a "), (4, 0, "user", "twice"), (4, 0, "user", "twice"), (5, 0, "user", "x" * 200_000), (5, 1, "assistant", "<s>" * 20_000)]


def test_chat_round_trip_and_loss(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    made = chat.format_chat(clashing(df)).withColumns({"back": chat.parse_chat(F.col("formatted")), "trained": chat.loss_text(F.col("segments"))})
    want = defaultdict(list)
    for conv, turn, role, text in CHATS:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    rows = {r["conv_id"]: r for r in made.collect()}
    assert set(rows) == set(want)
    for conv, turns in want.items():
        turns = [(r, t) for *_, r, t in sorted(turns)]
        assert [(t["role"], t["text"]) for t in rows[conv]["back"]] == turns
        assert rows[conv]["trained"] == "".join(t for r, t in turns if r == "assistant")
        assert rows[conv]["formatted"] == "".join(s["text"] for s in rows[conv]["segments"])
    assert [rows[c]["valid"] for c in (1, 2, 3, 4, 5)] == [True, False, False, False, True]
    assert (rows[2]["first_bad"], rows[3]["first_bad"], rows[4]["first_bad"], rows[None]["first_bad"]) == (0, 1, 1, 1)
    controls = chat.INSTRUCT.controls
    inside = [s["text"] for r in rows.values() for s in r["segments"][1::3]]
    assert not any(c in text for text in inside for c in controls)


def test_chat_of_nothing_and_a_template_that_cannot_be_read(spark):
    assert chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    with pytest.raises(ValueError):
        chat.ChatTemplate({"user": chat.Turn("U: ", "\n")}, ("[R]", "[:R]", "[/R]"), ("[R]", "[:R]", "[/R]"))


def water_fill(sizes, weights, most):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w, total, full = {s: weights[i % len(weights)] for i, s in enumerate(order)}, sum(sizes.values()), set()
    while True:
        level = (total - sum(most * sizes[s] for s in full)) / (sum(w[s] for s in sizes if s not in full) or 1)
        more = {s for s in sizes if s not in full and level * w[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in full else level * w[s] for s in sizes}
        full |= more


def test_mix_meets_its_targets(spark):
    df = clashing(frame(spark))
    got, again = mixing.pareto_mix(df).collect(), mixing.pareto_mix(df.repartition(5)).collect()
    key = lambda rows: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["source"] or "", r["taken"]) for r in rows)
    assert key(got) == key(again)
    sizes = Counter()
    for _, text, _, source, _ in awkward_docs():
        sizes[source] += len(WORD.findall(text or ""))
    targets, taken = water_fill(sizes, (1, 2, 3), 3), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= max(5, 0.002 * targets[s]) or s == "c" for s in sizes)  # c has a text of 30,000 words
    assert mixing.pareto_mix(frame(spark, [])).count() == 0


def test_inclusion_follows_the_probabilities(spark):
    """Documents four times as long are taken about twice as often: the probabilities grow with the root of the size."""
    rows = [(i, "w " * (10 if i % 2 else 40), "en", "a" if i < 2000 else "b", 0) for i in range(4000)]
    taken = Counter()
    for r in mixing.pareto_mix(frame(spark, rows), weights=(1, 9)).filter("source = 'a'").collect():
        taken[r["size"]] += r["copies"]
    assert 1.6 * taken[10] < taken[40] < 2.5 * taken[10]


def test_tokens_word_by_word_are_the_tokenizers_own():
    import pyarrow as pa
    tokenizer = WordTokenizer(TOKENIZER, max_words=40)
    texts = [r[1] or "" for r in awkward_docs()] + ["don't we'll I'VE 'sound it's", "<|endoftext|> <|ENDOFTEXT|>", "Σας ΟΔΟΣ á e ́ ½Ⅳ²", "a\x1cb c\x85d"]
    for part in (texts[:30], texts[30:]):
        ids, ends = tokenizer.encode(pa.array(part))
        for text, a, b in zip(part, [0, *ends], ends):
            assert ids[a:b].tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_places_every_id_once(spark):
    got = packing.pack_documents(clashing(frame(spark)), TOKENIZER, window=256, group_windows=64).collect()
    tokenizer = WordTokenizer(TOKENIZER).tokenizer
    want = Counter()
    for doc, text, *_ in awkward_docs():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        for at in range(0, len(ids), 256):
            part = np.array(ids[at:at + 256], dtype="<u4")
            want[doc, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    by, size = defaultdict(list), {}
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
        assert size.setdefault(r["sequence_id"], r["tier"]) == r["tier"]
    for sequence, pieces in by.items():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == size[sequence] if size[sequence] < 256 else at <= 256  # a short window is full
    assert sum(r["length"] for r in got) > 0.95 * sum(size.values())
    assert packing.pack_documents(frame(spark, []), TOKENIZER).count() == 0


def test_steps_of_a_group_are_level(spark):
    rows = [(i, "stone " * (i % 200 + 1), "en", "a", 0) for i in range(400)]
    got = packing.pack_documents(frame(spark, rows), TOKENIZER, window=256, steps=4).collect()
    windows = defaultdict(set)
    for r in got:
        windows[r["step_group"]].add(r["sequence_id"])
    assert len(windows) == 4 and max(map(len, windows.values())) - min(map(len, windows.values())) <= 1




def test_tiers_take_their_pieces_and_short_ones_fill_long_gaps():
    lengths = np.array([4096, 3000, 2048, 1100, 1000, 1000, 600, 424, 400, 96, 40, 24])
    where, offset, size, held = packing.pack_tiers(lengths, 4096, (512, 1024, 2048))
    windows = defaultdict(list)
    for i in range(len(lengths)):
        windows[where[i]].append((int(offset[i]), int(lengths[i])))
    found = sorted((int(size[w]), sorted(p)) for w, p in windows.items())
    # 2048, 600 + 424 = 1024 and (not 400 + 112, but) nothing at 512; 3000's gap takes 1000 + 96; what is left shares a long window.
    assert (2048, [(0, 2048)]) in found and (1024, [(0, 600), (600, 424)]) in found and (4096, [(0, 4096)]) in found
    assert (4096, [(0, 3000), (3000, 1000), (4000, 96)]) in found or (4096, [(0, 3000), (3000, 1000), (4000, 40), (4040, 24)]) in found or any(
        n == 4096 and p[0] == (0, 3000) and sum(x for _, x in p) > 4050 for n, p in found)
    for n, p in found:
        assert sum(x for _, x in p) == n or n == 4096


@pytest.mark.parametrize("seed", range(4))
def test_tiers_leave_little_padding(seed):
    r = np.random.default_rng(seed)
    lengths = np.sort(np.minimum(4096, np.maximum(1, r.lognormal(6.5, 1.1, size=4000).astype(int))))[::-1].copy()
    where, offset, size, held = packing.pack_tiers(lengths, 4096, (512, 1024, 2048))
    assert np.array_equal(np.bincount(where, weights=lengths).astype(int), held) and (held <= size).all()
    assert set(size.tolist()) == {512, 1024, 2048, 4096} and (held[size < 4096] == size[size < 4096]).all()
    assert held.sum() >= 0.99 * size.sum()
    for w in range(0, len(size), 50):
        own = np.flatnonzero(where == w)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == np.r_[0, np.cumsum(lengths[own])[:-1]].tolist()
