import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import mixing, packing, tokens
from labelloom.llm.op4 import op4_mix_sources
from labelloom.llm.op5 import tokenizer_path
from tests.llm.helpers import SF, awkward_documents, documents, empty_documents


def test_targets_reshare_the_excess(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 500)], "source string, size bigint")
    got = {r.source: r for r in mixing.source_targets(sized).collect()}
    assert got["a"].target == 30.0 and got["a"].weight == 5
    level = (2510 - 30 - 1500) / (2 + 1)  # a and the null source (weight 5 again) are full
    assert got["b"].target == pytest.approx(2 * level) and got["c"].target == pytest.approx(level)
    assert got[None].target == 1500.0 and got[None].weight == 5


def test_hypergeometric_follows_the_distribution(spark):
    n = 4000
    rows = spark.range(n).select(((F.col("id") + 0.5) / n).alias("u"))
    drawn = mixing.hypergeometric(F.lit(30), F.lit(70), F.lit(20), F.col("u"))
    values = np.array([r[0] for r in rows.select(drawn).collect()])
    assert values.min() >= 0 and values.max() <= 20
    assert values.mean() == pytest.approx(6.0, abs=0.02)
    assert values.var() == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.02)


def test_splitting_keeps_every_quota(spark):
    quotas = spark.createDataFrame([("a", 700), ("b", 44), ("c", 1), (None, 255)], "source string, blocks bigint")
    rows = mixing.split_quotas(quotas, depth=3).collect()
    for source, n in (("a", 700), ("b", 44), ("c", 1), (None, 255)):
        assert sum(r.blocks for r in rows if r.source == source) == n
    shards = [sum(r.blocks for r in rows if r.shard == s) for s in range(8)]
    assert sum(shards) == 1000 and max(shards) - min(shards) <= 1


def test_mix_takes_targets_and_draws_are_disjoint(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = mixing.plan_mix(docs)
    by_source = {r.source: r for r in plan.targets.collect()}
    taken = plan.mix.documents.groupBy("source").agg(F.sum("words").alias("w")).collect()
    for r in taken:
        assert r.w == round(by_source[r.source].target)
    assert plan.mix.documents.groupBy("key", "pass").count().filter("count > 1").count() == 0
    assert plan.mix.documents.groupBy("key").agg(F.sum("words").alias("w"), F.max("size").alias("s")).filter("w > 3 * s").count() == 0


def test_mixed_documents_keep_columns_and_words(spark):
    docs = awkward_documents(spark)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    sizes = sum(len(r.text.split()) for r in rows)
    plan = mixing.plan_mix(docs)
    assert sizes == sum(round(r.target) for r in plan.targets.collect())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(docs.repartition(5)).collect()))


def test_equal_rows_of_two_sources_are_counted_apart(spark, tmp_path):
    rows = [(1, "one two three", "a"), (1, "one two three", "b"), (1, "one two three", None), (2, "four five", "a"), (None, "six", "b"), (None, "six", "a")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op4_mix_sources(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    targets = mixing.plan_mix(spark.read.parquet(str(tmp_path / "documents.parquet"))).targets.collect()
    assert sum(r.taken for r in got) == sum(round(r.target) for r in targets)


def test_mix_of_nothing(spark):
    assert mixing.mix_documents(empty_documents(spark)).count() == 0


# --- packing ---


class Fresh:
    """The tokenizer file as its own library reads it."""

    def __init__(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path())

    def whole(self, text):
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def encoder():
    return Fresh()


@pytest.fixture(scope="module")
def batched():
    return tokens.ByteTokenizer(tokenizer_path())


def test_units_give_the_tokenizers_ids(encoder, batched):
    odd = [
        "", " ", "  ", "   a b", " a\n \n b", "a  b", "a   b \t c", "x \n", "x\n ", "  a  b", "a\x00b c",
        "it's he'll 12 3,4 <|endoftext|> z", " a\x85 b", "\x1c \x1d a", "a \x1cb", "a\n\nb", "\na b\n", "a!!. b",
        "a_.b _, c", "a .b ,c\n.d", "3.14,x", "a..b", "a., b", "a.\n", "é.è, ñ", "a\r\nb", "x\n\ty", "'s's.'t", "²., ½,",
    ]
    rnd = random.Random(3)
    odd += ["".join(rnd.choice("ab ,.\n\t!é'_1\u3000\u2003\xa0\x85\x1c\r漢😀²") for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    for text, ids in zip(odd, batched.batch(odd)):
        assert ids.tobytes() == encoder.whole(text), repr(text)
    for text in odd[:500]:
        assert batched.ids(text).tobytes() == encoder.whole(text), repr(text)


def test_added_tokens_have_the_files_own_ids(encoder, batched):
    texts = ["a b <|endoftext|> c", "<|endoftext|>", "x.<|endoftext|>, y\nz", "<|endoftext |> a", "<|endof text|>", "plain words, no more."]
    for text, ids in zip(texts, batched.batch(texts)):
        assert ids.tobytes() == encoder.whole(text), text
    assert 50256 in batched.batch(texts)[0]


def test_a_small_memo_and_long_texts_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 2000)
    monkeypatch.setattr(tokens, "LONG_BYTES", 300)
    fresh = tokens.ByteTokenizer(tokenizer_path())
    for at in range(10):
        texts = [f"alpha{at} beta{i} gamma delta{i * at}." * (1 + 20 * (i == 7)) for i in range(20)]
        assert [x.tobytes() for x in fresh.batch(texts)] == [encoder.whole(t) for t in texts]


def test_units_of_one_hash_are_told_apart(monkeypatch):
    data = np.frombuffer(b"ab cd ab xy cd", np.uint8)
    starts = tokens.unit_starts(data, np.array([0]))
    first, which = tokens.equal_units(data, starts)
    assert starts.tolist() == [0, 2, 5, 8, 11] and (first[which] == [0, 1, 2, 3, 1]).all()
    zero = np.zeros(1 << 21, np.uint64)
    monkeypatch.setattr(tokens, "_powers", lambda size: (zero[:size], zero[:size]))
    first, which = tokens.equal_units(data, starts)
    assert (first == which).all() and len(first) == 5


def check_pieces(docs, pieces, encoder, length=packing.SEQUENCE):
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append(encoder.whole(r.text or "") + b"\0\0\0\0")
    streams, places = {}, []
    for p in pieces:
        streams.setdefault(p.doc_id, []).append(p)
        places.append((p.sequence_id, p.offset, p.length))
    assert set(streams) == set(ids)
    for key, parts in streams.items():
        want = sum(len(x) // 4 for x in ids[key])
        assert sum(p.length for p in parts) == want
        if len(ids[key]) == 1:
            at = 0
            for p in sorted(parts, key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == want
                assert p.ids_crc32 == zlib.crc32(ids[key][0][4 * at : 4 * (at + p.length)])
                at += p.length
    places.sort()
    at = 0
    for s, o, n in places:
        assert s * length + o == at and o + n <= length
        at += n


def test_pieces_cover_every_id_once(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_pieces(docs, packing.pack_documents(docs, tokenizer_path()).collect(), encoder)


def test_awkward_rows_are_packed(spark, encoder):
    docs = awkward_documents(spark)
    check_pieces(docs, packing.pack_documents(docs, tokenizer_path()).collect(), encoder)
    assert packing.pack_documents(empty_documents(spark), tokenizer_path()).count() == 0


def test_windows_hold_the_mixture(spark):
    texts = ["alpha beta gamma delta " * 40] * 90 + ["one two three four five " * 40] * 30
    docs = documents(spark, texts).withColumn("source", F.when(F.col("doc_id") < 90, "a").otherwise("b")).repartition(4)
    made = packing.stored(packing.tokenized(docs, tokenizer_path()), "t")
    pieces = packing.pack(made, length=64, window=640, quantum=1)
    owner = docs.select("doc_id", "source")
    totals = {r.source: r.n for r in made.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    share = totals["a"] / sum(totals.values())
    windows = (
        pieces.join(owner, "doc_id").withColumn("w", F.floor((F.col("sequence_id") * 64 + F.col("offset")) / 640))
        .groupBy("w").agg(F.sum(F.when(F.col("source") == "a", F.col("length")).otherwise(0)).alias("a"), F.sum("length").alias("n")).collect()
    )
    assert all(abs(r.a - share * r.n) <= 4 for r in windows)


def test_schedule_matches_plain_steps():
    rnd = random.Random(8)
    for _ in range(60):
        sizes = [rnd.randint(1, 60) for _ in range(rnd.randint(1, 5))]
        targets = {i: rnd.choice([0.1, 0.25, 1, 2, 3.5]) for i in range(len(sizes))}
        weights = packing.weights_of(list(enumerate(sizes)), targets)
        plan = packing.Schedule(sizes, weights)
        time, place, left = Fraction(0), Fraction(0), set(range(len(sizes)))
        at = 0
        while left:
            # Place and credits go on in proportion until the next queue ends.
            end = min(Fraction(sizes[i], weights[i]) for i in left)
            rate = sum(weights[i] for i in left)
            while at <= place + (end - time) * rate:
                now = time + (at - place) / rate
                assert plan.spent(at) == [min(n, int(w * now)) for n, w in zip(sizes, weights)]
                at += 1
            place, time = place + (end - time) * rate, end
            left = {i for i in left if Fraction(sizes[i], weights[i]) > end}
        assert at == sum(sizes) + 1
        for i, n in enumerate(sizes):
            for t in range(n):
                p = plan.place_of(i, t)
                assert plan.spent(p)[i] > t >= plan.spent(p - 1)[i]


def test_targets_hold_in_every_sequence_until_a_queue_ends(spark, encoder):
    texts = ["alpha beta gamma delta " * 40] * 90 + ["one two three four five " * 40] * 30 + ["red blue " * 40] * 30
    name = F.when(F.col("doc_id") < 90, "a").when(F.col("doc_id") < 120, "b")
    docs = documents(spark, texts).withColumn("source", name).repartition(4)
    targets = {"a": 0.25, "b": 0.25, None: 0.5}
    pieces = packing.pack_documents(docs, tokenizer_path(), length=64, targets=targets, quantum=1).collect()
    check_pieces(docs, pieces, encoder, 64)
    by_sequence = {}
    for p in pieces:
        held = by_sequence.setdefault(p.sequence_id, Counter())
        held["a" if p.doc_id < 90 else "b" if p.doc_id < 120 else None] += p.length
    of = lambda s: [k for k, held in by_sequence.items() if held[s]]
    for k, held in by_sequence.items():
        if k < max(of(None)) - 1:
            assert all(abs(held[s] - 64 * t) <= 4 for s, t in targets.items())
        elif max(of(None)) + 1 < k < max(of("b")) - 1:
            assert abs(held["a"] - 32) <= 4 and abs(held["b"] - 32) <= 4
    assert max(of(None)) < max(of("b")) < max(of("a"))
    with pytest.raises(ValueError):
        packing.pack_documents(docs, tokenizer_path(), targets={"a": 1, "b": 1})


def test_a_sequence_holds_the_corpus_mixture(spark):
    docs = documents(spark, ["alpha beta gamma delta " * 300] * 8).withColumn("source", F.when(F.col("doc_id") < 4, "a").otherwise("b"))
    for r in packing.pack_documents(docs, tokenizer_path()).filter("length > 600").collect():
        raise AssertionError(r)


def test_products_beyond_64_bits():
    rnd = random.Random(4)
    rows = [(rnd.randrange(2**44), rnd.randrange(2**46), rnd.randrange(1, 2**50)) for _ in range(20_000)]
    rows = [(a, b, c) for a, b, c in rows if a * b // c < 2**50]
    rows += [(-a, b, c) for a, b, c in rows[:2000]] + [(2**44, 2**45, 2**45), (0, 5, 3), (7, 0, 3)]
    a, b, c = (np.array(x, np.int64) for x in zip(*rows))
    assert packing.mul_div(a, b, c).tolist() == [x * y // z for x, y, z in rows]


@pytest.mark.parametrize("quantum", [1, 3, 8, 50])
def test_quanta_match_plain_steps(quantum):
    """Round by round: a queue sends the whole quanta of its credit, and all when it ends."""
    rnd = random.Random(quantum)
    for _ in range(25):
        sizes = [rnd.randint(1, 300) for _ in range(rnd.randint(1, 5))]
        targets = {i: rnd.choice([0.1, 0.25, 1, 2, 3.5]) for i in range(len(sizes))}
        plan = packing.Schedule(sizes, packing.weights_of(list(enumerate(sizes)), targets))
        window, length, total = 40, 16, sum(sizes)
        sent, stream = [0] * len(sizes), []
        for place in [*range(window, total, window), total]:
            credit = plan.spent(place)
            for i, n in enumerate(sizes):
                upto = n if credit[i] == n else credit[i] // quantum * quantum
                stream += [(i, t) for t in range(sent[i], upto)]
                sent[i] = upto
        assert sent == sizes
        # Queues are cut into documents; each token is where the plain stream has it.
        docs = []
        for i, n in enumerate(sizes):
            at = 0
            while at < n:
                take = min(n - at, rnd.randint(1, 90))
                docs.append((i, at, take))
                at += take
        rnd.shuffle(docs)
        queue, at, n = (np.array(x, np.int64) for x in zip(*docs))
        placed = {}
        for d, start, size, place in zip(*(x.tolist() for x in packing.Cutter(plan, length, window, quantum).pieces(queue, at, n))):
            assert place // length == (place + size - 1) // length
            for k in range(size):
                placed[place + k] = (docs[d][0], docs[d][1] + start + k)
        assert [placed[p] for p in range(total)] == stream


def test_deficits_are_carried_over_rounds(spark, encoder):
    """A small source speaks in whole quanta, every few sequences, and has its share to within one over any run."""
    docs = documents(spark, ["alpha beta gamma delta " * 100] * 60).withColumn("source", F.when(F.col("doc_id") < 57, "a").otherwise("b")).repartition(4)
    pieces = packing.pack_documents(docs, tokenizer_path(), length=64, quantum=16).collect()
    check_pieces(docs, pieces, encoder, 64)
    held = Counter()
    for p in pieces:
        if p.doc_id >= 57:
            held[p.sequence_id] += p.length
    last = max(p.sequence_id for p in pieces)
    share, upto = 3 / 60, 0
    for k in range(last):
        upto += held[k]
        assert abs(upto - share * 64 * (k + 1)) <= 16 + 64
    assert len(held) < last / 2


def test_few_pieces_a_sequence(spark):
    pieces = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path())
    n = pieces.agg(F.count(F.lit(1)).alias("n"), F.max("sequence_id").alias("last")).first()
    assert n["n"] / (n["last"] + 1) < 9
