"""Lexical search, line dedup and conversation repair against plain versions."""

import hashlib
import math
import random
import re

import pytest

from barloom.llm import conversation_repair as cr
from barloom.llm import lexical_search, line_dedup

SPACE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Line dedup


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_lines(rows):
    """(id, n_lines, n_dropped, kept) of each row, by the docstring."""
    holders = {}
    for id, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(SPACE))
            if len(key) >= 20:
                holders.setdefault(key, set()).update([] if id is None else [id])
    gone = {key: max(ids) for key, ids in holders.items() if len(ids) >= 3}
    out = []
    for id, text in rows:
        lines = (text or "").split("\n")
        keys = [lower(line.strip(SPACE)) for line in lines]
        kept = [line for line, key in zip(lines, keys) if key not in gone or gone[key] == id]
        out.append((id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sorted_rows(rows):
    return sorted([tuple(r) for r in rows], key=repr)


def test_lines_equal_plain_version(spark):
    rng = random.Random(4)
    pool = [f"  A line that is long ENOUGH, number {i}" for i in range(30)] + ["short", "", "\t", "É" * 20, "é" * 20, "x" * 19, " " + "x" * 20 + "\r"]
    rows = [(i, "\n".join(rng.choice(pool).swapcase() if rng.random() < 0.3 else rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(100 + i, "one line that is in a third of all\nown line of this document " + str(i)) for i in range(30)]
    rows += [(None, "one line that is in a third of all\nleft"), (None, None), (None, ""), (7, "another text of an id\n" + pool[0]), (7, None)]
    rows += rows[:5] + [(200, "\n".join(pool * 300))] * 2
    df = spark.createDataFrame([(*r, -5, "x") for r in rows], "doc_id long, text string, n_lines int, `a.b` string")
    got = line_dedup.drop_repeated_lines(df, keep=["doc_id", "n_lines", "a.b"])
    assert got.columns == ["doc_id", "a.b", "n_lines", "n_dropped", "kept_text"]
    assert sorted_rows((r[0], *r[2:]) for r in got.collect()) == sorted_rows(plain_lines(rows))
    assert line_dedup.drop_repeated_lines(df.limit(0)).count() == 0


def test_hot_lines_are_not_shuffled_by_their_hash(spark, monkeypatch):
    rows = [(i, f"the same line in all documents\na line of a few documents {i % 20}") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 10, 1000):
        monkeypatch.setattr(line_dedup, "HOT_KEYS", hot)
        assert sorted_rows(line_dedup.drop_repeated_lines(df, keep=["doc_id"]).collect()) == sorted_rows(plain_lines(rows))


# Lexical search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k):
    bags = [(id, TERM.findall(lower(text or ""))) for id, text in docs]
    bags = [(id, words) for id, words in bags if words]
    n_docs, n_words = len(bags), sum(len(w) for _, w in bags)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(TERM.findall(lower(text or "")))
    out = []
    for item, terms in asked.items():
        found = []
        df = {t: sum(t in w for _, w in bags) for t in terms}
        for id, words in bags:
            m = 50 + 50 * len(words) * n_docs // n_words
            score = 0
            for t in terms:
                tf = words.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, id is None, id or 0))
        for rank, (score, missing, id) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if missing else id, -score))
    return sorted_rows(out)


@pytest.mark.parametrize("postings, window, share, held", [(1 << 20, 1024, 1 / 32, 1 << 20), (40, 4, 0.2, 1 << 20), (200, 8, 0.0, 12), (100, 16, 1.0, 30)])
def test_search_equals_plain_version(spark, postings, window, share, held):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["Größe", "größe", "ÉTÉ", "été", "a", "the", "1", "日本"]
    odds = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: rng.choice([" ", "-", ", "]).join(rng.choices(words, odds, k=n)).swapcase()
    docs = [(i, text(rng.choice([1, 3, 8, 20, 60]))) for i in rng.sample(range(1000), 150)]
    docs += docs[:9] + [(None, "w1 w2 w3"), (None, None), (5000, ""), (5001, "... --"), (5002, "w40 " * 3000), (-3, "w1 w2 w3"), (5003, "w1 w2 w3")]
    items = [(i, text(12)) for i in range(8)] + [(50, None), (51, "nosuchword"), (None, "w1 w50"), (3, "w59 w58"), (3, "w59 w58"), (52, " ".join(words))]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, score string").repartition(3)
    q = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    made = lexical_search.search(d, q, 7, segment_postings=postings, window=window, short_share=share, held_terms=held)
    assert sorted_rows(made.collect()) == plain_search(docs, items, 7)


def test_search_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert lexical_search.search(d.limit(0), q).count() == 0
    assert lexical_search.search(d, q.limit(0)).count() == 0
    assert [tuple(r) for r in lexical_search.search(d, q).collect()] == [(1, 1, 1, 287 * (1000000000 // (1000 + 20 * 100)))]


def test_windows_below_the_floor_are_skipped():
    import numpy as np

    n = 40_000
    # All documents hold the frequent term; only the first hold the rare one, so the rest cannot reach the floor.
    docs = np.concatenate([np.arange(n), np.arange(2000)]).astype(np.uint32)
    tfs = np.ones(len(docs), np.uint32)
    segment = lexical_search.Segment([0, 1], [n, 2000], docs.tobytes(), tfs.tobytes(), np.full(n, 10).tobytes(), n, 10 * n, 1024)
    best = lexical_search.Best(50)
    ids = np.arange(n)
    for share in (1 / 8, 0.0):
        best = lexical_search.Best(50)
        seen = lexical_search.search_segment(segment, np.array([0, 1]), np.array([1, 3000]), best, ids, ids >= 0, share)
        assert best.ids.tolist() == list(range(50)) and seen <= 2048


# Conversation repair


def plain_repair(rows):
    """Counts, cost, audit and repaired rows of one conversation's (turn, role, text), by trying all edits row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, faults = set(), []
    for _, role, text in rows:
        body = (text or "").strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def inserted(paths):
        for _ in range(2):
            for state, (cost, audit, out) in list(paths.items()):
                better(paths, step[state], (cost + 5, audit + "I", out + [(names[step[state]], "")]))
        return paths

    def better(paths, state, path):
        if state not in paths or path[:2] < paths[state][:2]:
            paths[state] = path

    paths = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        after, extra = {}, 5 if fault == "truncated" else 0
        initial = (role or "")[:1]
        for state, (cost, audit, out) in paths.items():
            better(after, state, (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            to = step[state]
            better(after, to, (cost + extra + 1, audit + "R", out + [(names[to], text)]))
            if initial == to or (initial == "s" and state == ""):
                better(after, initial, (cost + extra, audit + "K", out + [(role, text)]))
        paths = inserted(after)
    cost, audit, out = min((p for s, p in paths.items() if s in ("", "a")), key=lambda p: p[:2])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [(r or "")[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost), audit, sha("\n".join(f"{r}:{t}" for r, t in out))


def conversations(rng, n, longest):
    texts = ["Yes.", "No!", "Is it?", "cut off", "", " \n", "A. B", None, "Ende\t. \n", "été"]
    for conv in range(n):
        length = rng.choice([1, 2, 5, 9, longest])
        turns = sorted(rng.sample(range(length * 2), length))
        for turn in turns:
            text = rng.choice(texts)
            if text and rng.random() < 0.6:
                text = f"{turn} {text}"
            yield conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), text


@pytest.mark.parametrize("block_rows", [1, 4, 1 << 16])
def test_repair_equals_plain_version(spark, block_rows):
    rows = list(conversations(random.Random(block_rows), 60, 70))
    rows += [(None, None, "user", "No turn."), (None, 3, "assistant", "Yes."), (900, None, "user", "Only this.")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, cost string").repartition(4)
    made = cr.repair(df, block_rows=block_rows)
    told = {r["conv"]: (r["audit"], r["repaired_sha256"]) for r in cr.digests(made.edits).collect()}
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    found = {r["conv"]: tuple(r[c] for c in counts) for r in made.faults.collect()}
    for conv in {r[0] for r in rows}:
        want, audit, digest = plain_repair([r[1:] for r in rows if r[0] == conv])
        assert (found[conv], *told[conv]) == (want, audit, digest), conv
    assert len(found) == len(told) == len({r[0] for r in rows})


def test_repeated_rows_are_duplicates(spark):
    rows = [(1, 0, "user", "Hello there.")] * 3 + [(1, 1, "assistant", "Yes.")] * 2
    made = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), block_rows=2)
    assert [tuple(r) for r in cr.digests(made.edits).collect()] == [(1, "KDDKD", sha("user:Hello there.\nassistant:Yes."))]
    assert [tuple(r) for r in made.faults.collect()] == [(1, 0, 0, 3, 0, 3, 6)]


def test_repair_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    made = cr.repair(df)
    assert made.edits.count() == 0 and made.faults.count() == 0 and cr.digests(made.edits).count() == 0


def test_a_walk_stores_few_vectors(monkeypatch):
    rng = random.Random(1)
    codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 10]) for _ in range(10_000))
    whole, state, cost = cr.walk(codes, cr.NOTHING, cr.END, True)
    assert cost == cr.step_back(codes, cr.END)[cr.NOTHING] and state in (cr.NOTHING, cr.ASSISTANT)
    # Cut anywhere, with the vector at the cut, the walk is the same.
    for cut in (1, 77, 5000, 9999):
        end = cr.step_back(codes[cut:], cr.END)
        first, middle, _ = cr.walk(codes[:cut], cr.NOTHING, end, False)
        assert whole == first + cr.walk(codes[cut:], middle, cr.END, True)[0]
        assert tuple((cr.between(codes[:cut]) + cr.step_back(codes[cut:], cr.END)).min(axis=1)) == cr.step_back(codes, cr.END)


def test_very_long_texts(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (2, 0, "user", "x" * 3_000_000 + "?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(r["audit"] for r in cr.digests(cr.repair(df).edits).collect()) == ["D", "DD"]
    docs = spark.createDataFrame([(i, long + "\n" + long) for i in range(3)], "doc_id long, text string")
    assert sorted(r["n_dropped"] for r in line_dedup.drop_repeated_lines(docs).collect()) == [0, 2, 2]
    items = spark.createDataFrame([(1, "word " + "y" * 1_000_000)], "item_id long, text string")
    assert lexical_search.search(docs, items).count() == 3
