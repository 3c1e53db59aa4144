"""Tokens, packing, token files, shards, mixing, URL lists, neighbours and the pipeline."""

from __future__ import annotations

import collections
import datetime as dt
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check_oracles import duck, rows_of
from prepkit.llm import mixing, neighbours, packing, queries, sharding, token_files, tokens, url_lists
from prepkit.llm.order import ranked
from prepkit.llm.tokens import TextEncoder

FOLDER = "/root/testdata/sf0.001"
TABLES = ["documents", "odd", "empty"]


@pytest.mark.parametrize("name", [n for n, (_, sql) in queries.QUERIES.items() if sql])
def test_query_matches_sql(spark, name):
    run, sql = queries.QUERIES[name]
    assert rows_of(run(spark, FOLDER).toArrow()) == rows_of(duck(FOLDER).sql(sql).to_arrow_table())


def encoded(tokenizer, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer)
    return [e.ids for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_gives_the_library_ids(tokenizer):
    random.seed(4)
    signs = [*" \n\t\r\xa0 \x1c\x85  ab'sé1²٣漢\U0001f600.,!-\x00​", "the", "'ll", "<|endoftext|>", " \n", "x" * 90]
    texts = ["".join(random.choices(signs, k=random.randint(0, 20))) for _ in range(3000)] + [None, ""]
    ids, counts = TextEncoder(tokenizer).encode(pa.array(texts, pa.string()))
    want = encoded(tokenizer, texts)
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def in_order(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


@pytest.mark.parametrize("name", TABLES)
def test_packing(request, tokenizer, name):
    df = request.getfixturevalue(name)
    cut = [r.asDict() for r in packing.pieces(df, tokenizer, length=64).collect()]
    cut.sort(key=lambda r: (r["sequence_id"], r["offset"]))
    at, docs = 0, collections.Counter()
    stream = []
    for r in cut:
        assert r["sequence_id"] * 64 + r["offset"] == at and r["offset"] + r["length"] <= 64
        at += r["length"]
        stream += np.frombuffer(r["ids"], "<u4").tolist()
    rows = in_order(df)
    want = [ids + [1] for ids in encoded(tokenizer, [t for _, t in rows])]
    assert len(stream) == sum(map(len, want))
    pieces = collections.defaultdict(list)
    for r in cut:
        pieces[r["doc_id"]].append(r)
    got_docs, flat = collections.Counter(), iter(stream)
    del docs
    done: list[int] = []
    for r in cut:
        done += [next(flat) for _ in range(r["length"])]
        if r["start"] + r["length"] == r["doc_tokens"]:
            got_docs[(r["doc_id"], tuple(done))] += 1
            done = []
    assert got_docs == collections.Counter((d, tuple(w)) for (d, _), w in zip(rows, want, strict=True))
    whole = packing.sequences(df, tokenizer, length=64, pad_id=9).orderBy("sequence_id").collect()
    padded = stream + [9] * (-len(stream) % 64)
    assert [i for r in whole for i in r.ids] == padded
    assert sum(r.n_padding for r in whole) == len(padded) - len(stream)


def test_added_tokens_in_texts(tokenizer):
    texts = ["a <|endoftext|> b", "", None, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "plain  text\n", "<|endoftext"]
    ids, counts = TextEncoder(tokenizer).encode(pa.array(texts))
    want = encoded(tokenizer, texts)
    assert want[0] == [64, 220, 50256, 275]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_words_in_use_stay_known(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 60)
    coder, asked = TextEncoder(tokenizer), []
    library = coder._new
    coder._new = lambda words: asked.extend(words) or library(words)
    texts = [" ".join(["a", "met", *(f"w{i}x{k}," for k in range(10))]) for i in range(20)]
    for text, want in zip(texts, encoded(tokenizer, texts), strict=True):
        assert coder.encode(pa.array([text]))[0].tolist() == want
    assert len(coder.known) + len(coder.older) <= 60
    assert asked.count(" met") == 1


def test_marks_around_a_word_need_no_new_ids(tokenizer):
    coder, asked = TextEncoder(tokenizer), []
    library = coder._new
    coder._new = lambda words: asked.extend(words) or library(words)
    text = "we zorbled, zorbled. zorbled!) zorbled zorbled?!\nzorbled;\nzorbled zorblé, zorblé."
    assert coder.encode(pa.array([text]))[0].tolist() == encoded(tokenizer, [text])[0]
    assert len(asked) == len(set(asked))
    assert sorted(w for w in asked if "zorbl" in w) == [" zorbled", " zorblé", "zorbled"]


def test_ids_of_odd_words(tokenizer):
    rng = np.random.default_rng(5)
    signs = [*"ab'sZ09,.!-_$(  \n\t\r", "é", "漢", "—", "\u0301", "\xa0", "\u3000", "\U0001f600", "²", "ª", "'re", "'ll", "\x00"]
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 14, 5000)]
    ids, counts = TextEncoder(tokenizer).encode(pa.array(texts))
    want = encoded(tokenizer, texts)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_predictions_are_looked_up_once(monkeypatch):
    ids = np.minimum(np.random.default_rng(3).zipf(1.3, 50_000), 3000).astype(np.uint32)
    looked, guess = [], token_files.Model.guess
    monkeypatch.setattr(token_files.Model, "guess", lambda self, two, one: looked.append(one.size) or guess(self, two, one))
    token_files.encode_segment(ids, np.array([len(ids)]))
    assert sum(looked) < 1.1 * len(ids)


@pytest.mark.parametrize("name", TABLES)
def test_token_files(request, spark, tokenizer, name, monkeypatch):
    df = request.getfixturevalue(name)
    rows = in_order(df)
    want, at = [], 0
    for (d, _), ids in zip(rows, encoded(tokenizer, [t for _, t in rows]), strict=True):
        raw = np.array(ids + [0], "<u4").tobytes()
        want.append((d, len(ids) + 1, zlib.crc32(raw)))
    got = token_files.round_trip(df, tokenizer).orderBy("start").collect()
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert [r.doc_id for r in got] == [d for d, _ in rows]


@pytest.mark.parametrize("n", [0, 1, 2047, 2048, 2049, 9000])
@pytest.mark.parametrize("kind", ["any", "few", "same"])
def test_segments_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"any": rng.integers(0, 2**32, n, dtype=np.uint32), "few": rng.integers(0, 40, n).astype(np.uint32),
           "same": np.full(n, 2**32 - 1, np.uint32)}[kind]
    data = token_files.encode_segment(ids, np.array([n]))
    back, counts = token_files.decode_segment(data)
    assert (back == ids).all() and counts.tolist() == [n]
    if kind != "any" and n >= 2048:
        assert len(data) < n


def test_segments_come_near_the_entropy():
    ids = np.minimum(np.random.default_rng(3).zipf(1.3, 100_000), 3000).astype(np.uint32)
    p = np.bincount(ids)[np.unique(ids)] / len(ids)
    assert len(token_files.encode_segment(ids, np.array([len(ids)]))) < 1.15 * len(ids) * -(p * np.log2(p)).sum() / 8


def test_damage_is_found():
    data = bytearray(token_files.encode_segment(np.arange(5000, dtype=np.uint32) % 700, np.array([5000])))
    data[-100] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_segment(bytes(data))


def coded_bits(ids):
    return 8 * len(token_files.encode_segment(ids.astype(np.uint32), np.array([len(ids)]))) / len(ids)


def test_a_block_learns_what_follows_in_it():
    rng = np.random.default_rng(1)
    ids = np.concatenate([np.resize(rng.permutation(200), token_files.BLOCK) for _ in range(40)])
    assert coded_bits(ids) < 2.5


def test_a_block_counts_its_own_ids():
    rng = np.random.default_rng(2)
    ids = np.concatenate([rng.choice(rng.permutation(3000)[:16], token_files.BLOCK) for _ in range(40)])
    assert coded_bits(ids) < 7


def test_weights_adapt_to_the_block():
    ids = np.minimum(np.random.default_rng(3).zipf(1.3, 20_000), 3000).astype(np.uint32)
    mixture = token_files.Mixture(token_files.Model.fit(ids)[0], 2)
    at, marks = mixture.places(np.array([5, 5, 7, 7]))
    spent = []
    for _ in range(300):
        mixture.look(at, marks, np.array([8, 8, 16, 16], np.uint32))
        came = np.tile(mixture.ids[:2] + np.array([0, 1], np.uint32), 2)  # order 2 is right in the first block only
        before = mixture.shares(mixture.weight, 0)[:2]
        mixture.learn(came, came << 3 | 1)
        spent.append([before[0][0], before[1][1]])
    assert spent[-1][0] > 0.95 * token_files.TOTAL
    assert spent[-1][1] < 0.05 * token_files.TOTAL


def test_ids_met_once_are_coded():
    assert coded_bits(np.random.default_rng(4).permutation(1 << 14)[:9000]) < 16
    ids = (2**32 - 1 - np.arange(9000)).astype(np.uint32)
    assert (token_files.decode_segment(token_files.encode_segment(ids, np.array([9000])))[0] == ids).all()


def test_blocks_are_coded_on_their_own():
    ids = np.minimum(np.random.default_rng(5).zipf(1.4, 3 * token_files.BLOCK + 77), 5000).astype(np.uint32)
    model, at, guesses = token_files.Model.fit(ids)
    n = token_files.BLOCK
    rare = [ids[i * n:(i + 1) * n][at[i * n:(i + 1) * n] == len(model.table)] for i in range(3)]
    assert all(map(len, rare))
    together = token_files.encode_blocks(
        at[:3 * n].reshape(3, n), guesses[:, :3 * n].reshape(2, 3, n), np.concatenate(rare), n, model)
    for i in range(3):
        cut = slice(i * n, (i + 1) * n)
        assert token_files.encode_blocks(at[cut][None], guesses[:, None, cut], rare[i], n, model) == [together[i]]
        assert (token_files.decode_blocks([together[i]], n, n, model)[0] == ids[cut]).all()
    broken = [together[0], bytes(b ^ 255 for b in together[1]), together[2]]
    back = token_files.decode_blocks(broken, n, n, model)
    assert (back[0] == ids[:n]).all() and (back[2] == ids[2 * n:3 * n]).all() and (back[1] != ids[n:2 * n]).any()


def plain_jump(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_moves_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 2**60, 4000)
    for shards in (1, 2, 24, 25, 100):
        got = sharding.jump(keys, shards)
        assert got.tolist() == [plain_jump(int(k), shards) for k in keys]
        more = sharding.jump(keys, shards + 1)
        assert set(more[more != got]) <= {shards}


@pytest.mark.parametrize("name", TABLES)
def test_shard_manifest(request, name):
    df = request.getfixturevalue(name)
    got = sharding.shard_manifest(df, "doc_id", "text", 3).collect()
    want = collections.Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 3)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_ranks_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("g"), (F.col("id") * 7 % 5000).alias("x"))
    got = ranked(df, ["g"], [F.col("x")]).collect()
    groups = collections.defaultdict(list)
    for r in got:
        groups[r.g].append((r.x, r["rank"]))
    assert all([k for _, k in sorted(v)] == list(range(len(v))) for v in groups.values()) and len(got) == 5000


@pytest.mark.parametrize("name", TABLES)
def test_mix(request, name):
    df = request.getfixturevalue(name)
    got = mixing.mix(df).collect()
    assert sorted(((r.id, r["size"]) for r in got), key=repr) == sorted(
        ((r.doc_id, len((r.text or "").encode().split())) for r in df.collect()), key=repr)
    sizes, taken, target, shortest = collections.Counter(), collections.Counter(), {}, {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        shortest[r.source] = min(shortest.get(r.source, 10**9), r["size"] or 10**9)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r["size"]
    weights, want, budget = {}, {}, 1.5 * sum(sizes.values())
    for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or ""))):
        weights[s] = (3, 1, 2)[i % 3]
    open_ = set(weights)
    while open_:
        unit = (budget - sum(want.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > 2 * sizes[s]}
        if not full:
            want |= {s: unit * weights[s] for s in open_}
            break
        want |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        if name == "documents":
            assert abs(taken[s] - want[s]) <= shortest[s] / 2 + 0.002 * want[s]
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_url_lists(spark):
    events = [("block", "Bad.example", day(10), "add"), ("block", "bad.example", day(20), "remove"),
              ("block", "bad.example", day(30), "add"), ("block", "bad.example", day(31), "add"),
              ("allow", "good.bad.example", day(12), "add"), ("block", "tie.test", day(5), "add"),
              ("allow", "tie.test", day(5), "add"), ("block", "gone.test", day(5), "add"),
              ("block", "gone.test", day(5), "remove"), ("block", None, day(1), "add"), ("block", "x.test", None, "add")]
    captures = [(1, "http://bad.example/a", day(9)), (2, "http://u:p@WWW.bad.example:80/", day(10)), (3, "https://bad.example", day(20)),
                (4, "https://bad.example?x", day(40)), (5, "http://a.good.bad.example/", day(15)), (6, "http://a.good.bad.example/", day(11)),
                (7, "http://notbad.example/", day(15)), (8, "http://tie.test./", day(6)), (9, "http://gone.test/", day(6)),
                (10, None, day(15)), (11, "no url", day(15)), (12, "http://bad.example", None), (None, "http://bad.example", day(15)),
                (1, "http://bad.example/a", day(9)), (None, "http://fine.example", day(15)), (20, "http://bad.example", day(15)),
                (20, "http://fine.example", day(15)), (21, "http://[::1]:80/bad.example", day(15)), (22, "http://" + "a." * 5000 + "b/", day(15))]
    got = url_lists.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp_ntz"),
                             spark.createDataFrame(events, "list string, entry string, at timestamp_ntz, action string")).collect()
    assert len(got) == len(captures)
    assert {r.page_id for r in got if r.blocked} == {2, 4, 6, 20, None}
    assert [sum(r.blocked for r in got if r.page_id == i) for i in (20, None)] == [1, 1]
    assert {(r.page_id, r.entry) for r in got if r["list"] == "allow"} == {(5, "good.bad.example"), (8, "tie.test")}
    assert url_lists.evaluate(spark.createDataFrame([], "page_id long, url string, fetched_at timestamp_ntz"),
                              spark.createDataFrame(events, "list string, entry string, at timestamp_ntz, action string")).count() == 0
    urls = spark.createDataFrame([("http://[::1]:80/a",), ("http://u@A.b.:1",), ("x",)], "url string")
    assert [r[0] for r in urls.select(url_lists.host_of(F.col("url"))).collect()] == ["[::1]", "a.b", None]
    none = spark.createDataFrame([], "list string, entry string, at timestamp_ntz, action string")
    assert not any(r.blocked for r in url_lists.evaluate(spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp_ntz"), none).collect())


def test_neighbours_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    ids = np.array([r.vec_id for r in vectors.select("vec_id").collect()])
    x = np.array([r.embedding for r in vectors.collect()], float)
    near = neighbours.unit(x) @ neighbours.unit(x).T
    np.fill_diagonal(near, -2)
    got = collections.defaultdict(set)
    for r in neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), part_rows=128).collect():
        got[r.query_id].add(r.vec_id)
    hits = [len(got[i] & set(ids[np.argsort(-near[k])[:5]].tolist())) for k, i in enumerate(ids) if i % 50 == 0]
    assert np.mean(hits) / 5 >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], "q"), (2, [2.0, 0.0], ""), (3, [3.0, 0.0], ""), (4, [0.0, 1.0], ""), (5, None, ""), (6, [0.0, 0.0], ""),
            (7, [nan, 1.0], ""), (8, [None, 1.0], ""), (9, [float("inf"), 1.0], ""), (10, [], ""), (None, [1.0, 1.0], ""), (2, [2.0, 0.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, part string")
    got = neighbours.nearest(df, df, k=5).orderBy("query_id", "rank").collect()
    assert [(r["rank"], r.vec_id) for r in got if r.query_id == 1] == [(1, 2), (2, 3), (3, 4)]
    assert {r.query_id for r in got} == {1, 2, 3, 4}
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_of_uneven_and_repeated_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.1]), (5, [1.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, df, k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got == {1: [2, 4], 2: [1, 4], 4: [2, 1]}  # of other lengths: 3 and 5; 2 has two vectors


def test_neighbours_visit_more_parts_until_enough_are_found(spark, monkeypatch):
    router = np.array([[1.0, -1.0], [0.0, 0.0]]), np.zeros(2), 1  # by the sign of x, one part to visit
    monkeypatch.setattr(neighbours, "fit", lambda *a: router)
    rows = [(i, [1.0 if i < 3 else -1.0, i / 10]) for i in range(30)]  # three in one part
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, df).groupBy("query_id").count().collect()
    assert {(r.query_id, r["count"]) for r in found} == {(i, 5) for i in range(30)}



def test_pipeline(spark, documents):
    import corpus_pipeline
    from prepkit.llm.shared import written

    docs, sizes = documents, []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER), "test-stage")
        sizes.append(docs.count())
        if stage is not corpus_pipeline.pack:
            assert docs.schema.names == before.schema.names
    assert documents.count() >= sizes[0] >= sizes[1] >= sizes[2] > 0
    got = sorted(map(repr, corpus_pipeline.run(spark, FOLDER).collect()))
    assert got == sorted(map(repr, docs.collect()))
