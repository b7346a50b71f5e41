"""Phrases, the filter audit and decontamination against brute force, on odd and planted rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from plandrift.llm import decontamination, filter_audit, phrases

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n long, phrase string, items string"


def _prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(["ab", "Ab", "cd", "é", "x|y", "\x85", "zz", "q"]) + rng.choice([" ", " ", "  ", "\t", ", ", "\n", ". "])
                   for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, copies, and columns with clashing names."""
    rng = random.Random(5)
    long = " ".join(f"w{rng.randint(0, 60)}" for _ in range(4000))
    rows = [(1, long, "en", "a"), (2, None, "en", None), (3, "", None, "a"), (4, long, "en", "b"), (4, long, "en", "b"),
            (None, long, "en", "a"), (5, "one two three four", None, ""), (6, "One TWO three, four", "und", "")]
    rows += [(k, _prose(rng, rng.randint(0, 120)), rng.choice(["en", "de", None]), rng.choice("abc")) for k in range(10, 60)]
    rows += [(k, rows[10][1], "de", "c") for k in range(60, 70)]
    return spark.createDataFrame([(*r, 0, "p", "i") for r in rows], DOCS).repartition(7)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


# -- phrases --------------------------------------------------------------------------


def brute_phrases(rows, support, share, top):
    f, n = Counter(), Counter()
    for row in rows:
        lang = "und" if row["lang"] is None else row["lang"]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (row["text"] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    out = []
    for (lang, w), a in found.items():
        score, _, l, r = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        if not any(g == lang and len(v) > len(w) and 100 * b >= share * a and w in (v[:2], v[1:]) for (g, v), b in found.items()):
            out.append((lang, " ".join(w), a, l, r, n[lang], score))
    out.sort(key=lambda x: (x[0], -x[6], -x[2], x[1].encode()))
    rank = Counter()
    ranked = []
    for row in out:
        rank[row[0]] += 1
        if top is None or rank[row[0]] <= top:
            ranked.append((row[0], rank[row[0]], *row[1:]))
    return ranked


@pytest.mark.parametrize(("support", "share", "top", "shards"), [(10, 50, 2000, 3), (2, 90, 7, 1), (3, 50, None, 4)])
def test_phrases_equal_brute_force(docs, support, share, top, shards):
    got = phrases.collocations(docs, support, share, top, shards)
    assert sorted(map(tuple, got.collect())) == sorted(brute_phrases(docs.collect(), support, share, top))


def test_phrases_of_long_texts_in_slices(docs, monkeypatch):
    """A text beyond the bounds is taken in slices, and each of its phrases is counted once."""
    texts = [r["text"] or "" for r in docs.collect()]
    whole, sliced = phrases.PhraseCounter(), phrases.PhraseCounter()

    def counted(counter):
        total = Counter()

        def add():
            keys, counts, _ = counter.flush()
            low = (1 << phrases.ID_BITS) - 1
            for key, count in zip(keys.tolist(), counts.tolist()):
                ids = (key >> 2 * phrases.ID_BITS, key >> phrases.ID_BITS & low, key & low)
                total[tuple(counter.words[i] for i in ids if i)] += count

        for text in texts:
            for _ in counter.slices("en", text.encode()):
                add()
                counter._clear()
        add()
        return total

    want = counted(whole)
    monkeypatch.setattr(phrases, "SLICE", 5)
    monkeypatch.setattr(phrases, "MOST_TOKENS", 12)
    assert counted(sliced) == want


def test_no_phrases(docs, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10**13
    row = spark.range(1).select(phrases._score(F.lit(big - 1), F.lit(big), F.lit(big + 7)).alias("s")).first()
    assert row["s"] == 10**6 * (big - 1) ** 2 // (big * (big + 7))


# -- filter audit ---------------------------------------------------------------------


def brute_audit(rows, labels):
    first = {}
    for r in rows:
        text, i = r["text"] or "", r["doc_id"]
        first[text] = min(first.get(text, (True, 0)), (i is None, i or 0))
    good = {r["doc_id"] for r in labels if r["quality"] == 1 and r["doc_id"] is not None}
    toxic = {r["doc_id"] for r in labels if r["toxic"] == 1 and r["doc_id"] is not None}
    fails = []
    for r in rows:
        text, words = r["text"] or "", SPACE.findall(r["text"] or "")
        fails.append({"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                      "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                      "E": first[text] < (r["doc_id"] is None, r["doc_id"] or 0)})
    out = {}
    for part in {r["source"] or "" for r in rows}:
        mine = [(r, f) for r, f in zip(rows, fails) if (r["source"] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(mine)))
            for step, letter in enumerate(order, 1):
                gone = [i for i in left if mine[i][1][letter]]
                late = sum(f[letter] for _, f in mine) - len(gone)
                left = [i for i in left if not mine[i][1][letter]]
                ids = [mine[i][0]["doc_id"] for i in gone]
                out[part, order, step] = [len(left), len(gone), late, sum(f[letter] and sum(f.values()) == 1 for _, f in mine),
                                          sum(i in good for i in ids), sum(i in toxic for i in ids)]
    total = Counter()
    for (part, order, step), row in out.items():
        total[part, order[step - 1]] += row[1]
    return {(part, order, step, *row, total[part, order[step - 1]]) for (part, order, step), row in out.items()}


def test_audit_equals_brute_force(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (12, 1, None), (13, None, 1), (60, 1, 1), (4, 1, 0), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, labels)
    want = brute_audit(docs.collect(), labels.collect())
    assert len(want) == 4 * 600 and got.count() == len(want)
    assert {tuple(r) for r in got.collect()} == want
    assert filter_audit.audit(empty, labels).count() == 0
    unlabelled = filter_audit.audit(docs, labels.where("false"))
    assert unlabelled.agg(F.sum(F.col("good_lost") + F.col("toxic_lost")).alias("n")).first()["n"] == 0


def test_ranks_are_lexicographic():
    orders = ["".join(o) for o in permutations(filter_audit.FILTERS)]
    assert [filter_audit.rank_of(o) for o in orders] == list(range(filter_audit.ORDERS))


# -- decontamination ------------------------------------------------------------------

ITEMS = [(1, "One two, three FOUR"), (2, "w1"), (3, None), (4, " ?! "), (5, "a b c d e f g h i j k l"), (5, "zz q"),
         (6, "b c d e f g h i j k l"), (None, "cd cd"), (10, "é é é"), (7, "a b c d e f g h i j k l")]


def brute_digests(rows, items, width):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = []
    for r in rows:
        w, hit, found = words(r["text"]), set(), set()
        for i in items:
            line = words(i["text"])
            for s in range(max(1, len(line) - width + 1) if line else 0):
                window = line[s:s + width]
                for p in range(len(w) - len(window) + 1):
                    if w[p:p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        found.add("" if i["item_id"] is None else str(i["item_id"]))
        out.append((r["doc_id"], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture(scope="module")
def suspects(spark, docs):
    more = [(200, "x a b c d e f g h i j k l", "en", "s"), (201, "A. B! c-d\ne  f g h i j", "en", "s"), (202, "b c d e f g h i j k m", "en", "s"),
            (203, "a b c d e f g h i", "en", "s"), (204, "zzq zz" + " q" * 30, "en", "s"), (205, "é" * 3 + " É é é é", "en", "s")]
    return docs.select("doc_id", "text", "items").unionByName(
        spark.createDataFrame([(a, t, "i") for a, t, _, _ in more], "doc_id long, text string, items string"))


@pytest.mark.parametrize("block_words", [100_000, 6])
def test_decontamination_equals_brute_force(spark, suspects, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    small = suspects.where("doc_id <> 1 and doc_id <> 4 or doc_id is null").where("length(text) < 2000 or text is null")
    got = decontamination.digests(small, items, block_words=block_words)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute_digests(small.collect(), items.collect(), 10), key=key)


def test_spans_are_those_of_the_original(spark, suspects):
    items = spark.createDataFrame([(5, "a b c d e f g h i j k l")], "item_id long, text string")
    spans = {(r["doc_id"], r["passage"]) for r in decontamination.contaminated_spans(suspects, items).collect()}
    assert spans == {(200, "a b c d e f g h i j k l"), (201, "A. B! c-d\ne  f g h i j")} | {(202, "b c d e f g h i j k")} \
        - {(202, "b c d e f g h i j k m")}
    text = suspects.where("doc_id = 201").first()["text"]
    row = decontamination.contaminated_spans(suspects, items).where("doc_id = 201").first()
    assert text[row["start"]:row["end"]] == row["passage"]


def test_clean_documents_stay_whole(spark, suspects):
    items = spark.createDataFrame(ITEMS[4:5], "item_id long, text string")
    hit = decontamination.digests(suspects, items)
    kept = decontamination.decontaminated(suspects, items)
    assert kept.columns == suspects.columns
    assert kept.count() == hit.where("not contaminated").count() == suspects.count() - 3
    assert decontamination.decontaminated(suspects, items.where("false")).count() == suspects.count()
    assert decontamination.digests(suspects.where("false"), items).count() == 0


def test_windows_across_pieces_of_a_long_item(spark, monkeypatch):
    """An item cut into pieces loses no window, and one across the cut is found."""
    monkeypatch.setattr(decontamination, "PIECE", 7)
    words = [f"v{i}" for i in range(60)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    texts = spark.createDataFrame([(s, "x " + " ".join(words[s:s + 10]) + " x") for s in range(51)], "doc_id long, text string")
    got = decontamination.digests(texts, items, block_words=20)
    assert got.where("n_hit <> 10 or n_items <> 1").count() == 0
