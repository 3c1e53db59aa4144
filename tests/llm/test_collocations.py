"""Collocations against counting everything in plain Python."""

from __future__ import annotations

import collections
import random
import re

import pytest

from prepkit.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long"


def plain(rows, top, longest, least, share):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    found = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), f in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if 100 * f >= share * found[lang, words[i:i + k]]:
                    gone.add((lang, words[i:i + k]))
    best = collections.defaultdict(list)
    for (lang, words), a in found.items():
        if (lang, words) not in gone:
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
            score, _, l, r = min((2000000 * a // (x + y), k, x, y) for k, (x, y) in enumerate(cuts))
            best[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, some in best.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(some)[:top]))


def ours(df, **options):
    got = collocations.collocations(df, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(map(tuple, got.collect()))


def some_texts(seed: int, n: int = 300):
    """Words of very unequal frequency and stock phrases, some inside longer ones and behind a common word."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["The", "of", "ß", "漢字", " x"]
    stock = ["united states", "the united states", "New York stock exchange", "in spite of", "a b c d e", "x x x x x", "red\ttape"]
    rows = []
    for _ in range(n):
        parts = [draw.choice(stock) if draw.random() < 0.2 else draw.choice(words[int(draw.random() ** 3 * 45):] or words)
                 for _ in range(draw.randint(0, 40))]
        seps = [draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b"]) for _ in parts]
        rows.append(("".join(p + s for p, s in zip(parts, seps)), draw.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), ("...", "fr"), ("only two", "fr")] + rows[:20]


@pytest.mark.parametrize("options", [
    dict(top=5, longest=4, least=5, share=80), dict(top=10000, longest=4, least=3, share=80),
    dict(top=3, longest=5, least=4, share=50), dict(top=2, longest=2, least=5, share=80),
    dict(top=40, longest=3, least=2, share=100)])
def test_phrases(spark, options):
    rows = some_texts(options["top"])
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    assert ours(df, **options) == plain(rows, **options)


def test_full_filters_and_small_blocks(spark, monkeypatch):
    """Filters that let nearly everything through, many blocks, and a floor that has to be lowered."""
    monkeypatch.setattr(collocations, "MAX_BITS", 1 << 6)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 500)
    monkeypatch.setattr(collocations, "STEP", 100_000)
    rows = some_texts(9, 120)
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(2)
    options = dict(top=4, longest=4, least=2, share=30)
    assert ours(df, **options) == plain(rows, **options)


def test_floor_is_lowered_until_enough_survive(spark, monkeypatch):
    rounds = []
    grown = collocations.grown
    monkeypatch.setattr(collocations, "grown", lambda *a: rounds.append(1) or grown(*a))
    # Pairs of the highest scores are all absorbed by one long phrase.
    rows = [("a b c d e f g h i j", "en")] * 6 + [(f"x{i} y{i} x{i} y{i // 2} z", "en") for i in range(8) for _ in range(5)]
    df = spark.createDataFrame([(i, t, lang, "x", 1) for i, (t, lang) in enumerate(rows)], SCHEMA)
    options = dict(top=9, longest=4, least=3, share=80)
    assert ours(df, **options) == plain(rows, **options) and len(rounds) > 1


def test_empty(spark):
    for rows in ([], [(1, None, None, None, None)], [(1, "a b", "en", None, None)]):
        assert ours(spark.createDataFrame(rows, SCHEMA)) == []


@pytest.mark.parametrize("a, part", [
    (9 * 10**18, 9 * 10**18), (10**15 - 1, 10**15), (10**18 - 1, 10**18), (9 * 10**18 - 1, 9 * 10**18), (7, 10**6)])
def test_scores_are_exact(spark, a, part):
    df = spark.createDataFrame([("en", "x y", a, part, part, 1)], "lang string, phrase string, a long, l long, r long, k int")
    row = collocations.judged(df).first()
    assert (row.score, row.bound) == (2_000_000 * a // (2 * part), 2_000_000 * a // (part + a))


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_tables(request, name):
    df = request.getfixturevalue(name)
    rows = [(r.text, r.lang) for r in df.collect()]
    options = dict(top=2000, longest=4, least=30 if name == "documents" else 2, share=80)
    assert ours(df, **options) == plain(rows, **options)
