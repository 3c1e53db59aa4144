"""Line dedup, SimHash, quality rules and repeated paragraphs against plain Python over whole small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import pathlib
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from prepkit.llm import line_dedup, quality, shared, simhash, substring_dedup
from prepkit.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return text.translate({i: i + 32 for i in range(65, 91)})


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def rooted(n: int, links) -> list[int]:
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def plain_line_dedup(rows):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    order = {d: (d is None, d) for d, _ in rows}
    held = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2
                or min(held[key(x)], key=order.get) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup(request, name, min_docs):
    df = request.getfixturevalue(name)
    done = line_dedup.dedup_lines(df, min_docs=min_docs)
    assert set(df.columns) <= set(done.columns)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept_text.encode()).hexdigest())
                  for r in done.collect()), key=repr)
    if min_docs == 2:
        assert got == plain_line_dedup(texts_of(df))
    assert len(got) == df.count()


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
def test_simhash(request, name):
    df = request.getfixturevalue(name)
    rows = texts_of(df)
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = rooted(len(rows), links)
    ids = collections.defaultdict(list)
    for (d, _), root in zip(rows, roots, strict=True):
        ids[root].append(d)
    least = {root: min((d for d in v if d is not None), default=None) for root, v in ids.items()}
    want = sorted(((d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, roots, strict=True)), key=repr)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_groups(df).collect()), key=repr)
    assert got == want
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, least.values()))


def test_each_component_keeps_one_row(spark):
    rng = np.random.default_rng(11)
    texts = [" ".join(map(str, rng.integers(0, 10**9, 60))) for _ in range(9)]
    rows = [(None, t) for t in texts[:6]] + [(None, texts[0])] * 3  # different texts and copies without an id
    rows += [(1, texts[6]), (1, texts[7]), (1, texts[7]), (2, texts[7]), (None, texts[7]), (3, None), (None, texts[8]), (9, texts[8])]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = [(None, t) for t in texts[:6]] + [(1, texts[6]), (1, texts[7]), (3, None), (9, texts[8])]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))


def test_large_bucket_links_like_all_pairs():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 16, 3000).astype(np.int64) << 24)
    links = simhash._links(values)
    at = {v: i for i, v in enumerate(values.tolist())}
    got = rooted(len(values), [(at[a], at[b]) for a, b in links.tolist()])
    close = np.argwhere(np.triu(np.bitwise_count(values[:, None] ^ values[None, :]) <= 2, 1))
    assert got == rooted(len(values), close.tolist())


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(200, 200), (None, 7)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect())
    assert got == {i: 100 for i in range(100, 141)} | {i: 0 for i in range(60)}


def plain_base(text):
    words = WORD.findall(text or "")
    seen = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
def test_base_rules(request, name):
    df = request.getfixturevalue(name)
    want = []
    for d, t in texts_of(df):
        base = plain_base(t)
        want.append((d, *base, base[0] < 10 or 100 * base[4] > 20 * base[0]))
    got = quality.score(df).collect()
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.kept == (not r.base_failed and (r.perplexity is None or r.lower_band <= r.perplexity <= r.upper_band))
               for r in got)
    kept = quality.kept_documents(df)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)


def plain_kneser_ney(texts):
    """Probabilities of all 5-grams by the textbook recursion."""
    grams = collections.Counter()
    for t in texts:
        s = "\x02" * 4 + re.sub(r"[\t-\r \xa0]+", " ", (t or "").lower())
        grams.update(s[i - 4:i + 1] for i in range(4, len(s)))
    tables = {5: grams}
    for k in range(4, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    prob = {}
    for k in range(1, 6):
        n = [sum(c == i for c in tables[k].values()) for i in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
            d = [0, *[min(max(x, 0.05), i - 0.05) for i, x in enumerate(raw, 1)]]
        sums, left = collections.Counter(), collections.Counter()
        for g, c in tables[k].items():
            sums[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
        prob |= {g: (c - d[min(c, 3)]) / sums[g[:-1]] + left[g[:-1]] / sums[g[:-1]] * (prob[g[1:]] if k > 1 else 1 / 4096)
                 for g, c in tables[k].items()}
    return prob


def test_perplexity_is_modified_kneser_ney(spark):
    texts = ["the cat sat on the mat and the dog ran", "the dog sat on the log while a cat ran off", "zzz qqq the cat\n\n x"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    prob = plain_kneser_ney(texts)
    for r in quality.score(df).collect():
        s = "\x02" * 4 + re.sub(r"\s+", " ", texts[r.doc_id].lower())
        logs = [math.log(prob[s[i - 4:i + 1]]) for i in range(4, len(s))]
        assert math.log(r.perplexity) == pytest.approx(-sum(logs) / len(logs), abs=1e-5)


def plain_held_out(texts, out):
    """Mean log probability of a text under the counts of the others, with the discounts of all."""
    padded = ["\x02" * 4 + re.sub(r"[\t-\r \xa0]+", " ", t.lower()) for t in texts]
    cut = [[s[i - 4:i + 1] for i in range(4, len(s))] for s in padded]

    def tables(some):
        made = {5: collections.Counter(g for gs in some for g in gs)}
        for k in range(4, 0, -1):
            made[k] = collections.Counter(g[1:] for g in made[k + 1])
        return made

    d = {}
    for k, table in tables(cut).items():
        n = [sum(c == i for c in table.values()) for i in range(5)]
        d[k] = [0, 0.5, 1.0, 1.5]
        if n[1] and n[2] and n[3]:
            y = n[1] / (n[1] + 2 * n[2])
            raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
            d[k] = [0, *[min(max(x, 0.05), i - 0.05) for i, x in enumerate(raw, 1)]]
    held = tables(cut[:out] + cut[out + 1:])

    def p(g):
        k = len(g)
        if not k:
            return 1 / 4096
        same = {x: c for x, c in held[k].items() if x[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        left = sum(d[k][min(c, 3)] for c in same.values())
        c = same.get(g, 0)
        return (c - d[k][min(c, 3)] + left * p(g[1:])) / sum(same.values())

    return sum(math.log(p(g)) for g in cut[out]) / len(cut[out])


@pytest.mark.parametrize("size", [4_000_000, 20])
def test_held_out_perplexity_leaves_the_document_out(spark, monkeypatch, size):
    monkeypatch.setattr(quality, "SLICE", size)
    texts = ["the cat sat on the mat and the dog ran", "the dog sat on the log while a cat ran off", "zzz qqq zzz the cat\n\n x",
             "zzz qqq zzz ###"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in quality.score(df).collect():
        assert -math.log(r.held_out_perplexity) == pytest.approx(plain_held_out(texts, r.doc_id), abs=1e-9)


def test_junk_among_documents_is_rejected(spark, documents):
    rng = np.random.default_rng(8)
    kinds = ["#*$%&|<>", "bcdfghjklmnpqrstvwxz", "0123456789"]
    rows = [(r.doc_id, r.text, r.lang) for r in documents.select("doc_id", "text", "lang").collect()]
    junk = {}
    for lang in ("en", "de", "fr", "es"):
        for kind in kinds:
            words = ["".join(rng.choice(list(kind), rng.integers(2, 9))) for _ in range(200)]
            junk[-1 - len(junk)] = (lang, kind)
            rows.append((-len(junk), " ".join(words), lang))
    got = quality.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert not [junk[r.doc_id] for r in got if r.doc_id in junk and (r.kept or r.base_failed)]
    real = [r.kept for r in got if r.doc_id not in junk and not r.base_failed]
    assert 0.85 * len(real) < sum(real)


def test_model_slices_add_up(documents, monkeypatch):
    whole = {r.doc_id: r.perplexity for r in quality.score(documents).collect()}
    monkeypatch.setattr(quality, "SLICE", 8000)
    sliced = {r.doc_id: r.perplexity for r in quality.score(documents).collect()}
    assert sliced.keys() == whole.keys()
    assert all(sliced[d] == pytest.approx(whole[d], rel=1e-6) for d in whole)


def test_noise_is_rejected_and_prose_kept(spark):
    rng = np.random.default_rng(5)
    words = "the of and to in is that for it with as was on be at by this had not are but from or have an".split()
    prose = [" ".join(rng.choice(words, 120)) for _ in range(200)]
    noise = ["".join(chr(c) for c in rng.integers(0x4E00, 0x5E00, 4)) for _ in range(60)]
    rows = [(i, t, "en") for i, t in enumerate([*prose, " ".join(noise)])]
    kept = {r.doc_id for r in quality.score(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.kept}
    assert kept == set(range(200))


def plain_repeats(rows, similarity=0.8):
    found = []
    for d, t in rows:
        for place, line in enumerate((t or "").split("\n")):
            words = line.encode().lower().split()
            if len(words) >= substring_dedup.MIN_WORDS:
                found.append((d, place, frozenset(zip(*(words[k:] for k in range(5)), strict=False))))
    links = [(i, j) for i in range(len(found)) for j in range(i)
             if len(found[i][2] & found[j][2]) >= similarity * len(found[i][2] | found[j][2])]
    groups = collections.defaultdict(list)
    for i, root in enumerate(rooted(len(found), links)):
        groups[root].append(found[i][:2])
    out = []
    for group in groups.values():
        if len(group) > 1:
            lead = min(group, key=lambda g: (g[0] is not None, g))
            out += [(*g, *lead, len(group)) for g in group]
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["documents", "odd", "empty"])
@pytest.mark.parametrize("small", [24, 1])
def test_repeated_paragraphs(request, name, small, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SMALL_BUCKET", small)
    df = request.getfixturevalue(name)
    got = substring_dedup.repeated_paragraphs(df).collect()
    assert sorted(((r.doc_id, r.place, r.cluster_id, r.cluster_place, r.n_paragraphs) for r in got), key=repr) == plain_repeats(texts_of(df))


def chains(n_chains: int = 12, n_links: int = 9) -> list[tuple]:
    """Paragraphs that all share a passage, in chains whose neighbours are similar and whose ends are not."""
    passage = [f"common{i}" for i in range(60)]
    out = []
    for chain in range(n_chains):
        own = [f"own{chain}x{i}" for i in range(40)]
        for link in range(n_links):
            words = [f"new{chain}y{i}" for i in range(3 * link)] + own[3 * link:] + passage
            out.append((len(out), " ".join(words)))
    return out


@pytest.mark.parametrize("turns", [0, 2])
def test_no_link_is_lost_in_large_buckets(spark, turns, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SMALL_BUCKET", 1)
    monkeypatch.setattr(substring_dedup, "LEAD_TURNS", turns)
    rows = chains()
    got = substring_dedup.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.place, r.cluster_id, r.cluster_place, r.n_paragraphs) for r in got), key=repr) == plain_repeats(rows)


def test_removed_paragraphs_leave_the_rest(spark, documents):
    gone = {(r.doc_id, r.place) for r in substring_dedup.repeated_paragraphs(documents).collect() if r.removed}
    assert gone
    after = dict(texts_of(substring_dedup.drop_repeated_paragraphs(documents)))
    for d, t in texts_of(documents):
        assert after[d] == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)


def passage_rows() -> list[tuple]:
    """Passages of 50 words inside longer lines and across lines, in rows with equal, null and single ids."""
    rng = np.random.default_rng(23)

    def fresh(n):
        return [f"w{i}" for i in rng.integers(0, 10**9, n)]

    passages = [fresh(50) for _ in range(40)]
    rows = []
    for i, passage in enumerate(passages):
        broken = " ".join(passage[:17]) + "\n" + "  ".join(passage[17:31]).upper() + "\n\n" + " ".join(passage[31:])
        rows.append((2 * i, " ".join([*fresh(70), *passage, *fresh(60)])))
        rows.append((2 * i + 1, " ".join(fresh(33)) + "ß漢 " + broken + " " + " ".join(fresh(9))))
    rows += [(None, " ".join([*fresh(40), *passages[0]])), (None, " ".join([*passages[1], *fresh(40)]))]
    rows += [(7000, rows[0][1]), (7000, rows[2][1]), (7000, rows[2][1])]
    return rows + [(8000 + i, " ".join(fresh(200))) for i in range(20)] + [(9000, "same " * 300), (9001, None), (9002, "")]


def test_passages_inside_and_across_lines(spark):
    rows = passage_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.repeated_paragraphs(df, window=substring_dedup.WINDOW_WORDS).collect()
    found = {r.doc_id for r in got}
    assert found == {*range(80), None, 7000}
    assert {r.doc_id for r in got if r.cluster_id is None} == {None, 0, 1, 2, 3, 7000}
    assert any(r.removed for r in got if r.doc_id == 7000)
    texts = collections.defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    for r in got:
        cuts = [(t or "")[r.start:r.stop].split() for t in texts[r.doc_id]]
        assert not r.window or any(len(c) == substring_dedup.WINDOW_WORDS for c in cuts)
    for i in range(4, 80, 2):  # the first row keeps its passage, the other loses it
        assert not any(r.removed for r in got if r.doc_id == i)
        assert all(r.removed for r in got if r.doc_id == i + 1)


def test_every_shared_stretch_of_fifty_words_is_found(documents):
    rows = [(d, (t or "").encode().lower().split()) for d, t in texts_of(documents)]
    holders = collections.defaultdict(set)
    for d, words in rows:
        for i in range(len(words) - 49):
            holders[hash(tuple(words[i:i + 50]))].add(d)
    shared = {d for held in holders.values() if len(held) > 1 for d in held}
    got = substring_dedup.repeated_paragraphs(documents, window=substring_dedup.WINDOW_WORDS).collect()
    assert shared and shared <= {r.doc_id for r in got if r.window}


def test_columns_named_like_helpers(spark):
    rows = [(1, LINE, 5, None), (2, LINE, None, "x"), (3, "other", 7, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone_id int, gone_places string")
    done = {tuple(r) for r in substring_dedup.drop_repeated_paragraphs(df).collect()}
    assert done == {(1, LINE, 5, None), (2, "", None, "x"), (3, "other", 7, "y")}


LINE = " ".join(f"word{i}" for i in range(30))


def test_written_tables_leave_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [pathlib.Path(d.getPath()) for d in manager.localDirs()]

    def shuffled() -> set[pathlib.Path]:
        return {f for folder in folders for f in folder.rglob("shuffle_*")}

    before, setting = shuffled(), spark.conf.get(shared.DROP_SHUFFLES)
    table = shared.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "dropped")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before
    assert spark.conf.get(shared.DROP_SHUFFLES) == setting
    assert sum(r["count"] for r in table.collect()) == 1000
