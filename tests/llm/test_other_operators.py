"""Vectors, conversations, SentencePiece, the pipeline and the registered queries."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from barloom.llm import ann, quotation_linking, sentencepiece_viterbi
from barloom.llm.catalog import ORACLE, QUERIES
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


def test_nearest_equals_brute_force_and_breaks_ties_by_id(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[100:400] = x[7]  # one vector many times
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    odd = [(5000, None, 1), (5020, [0.0] * 16, 1), (5040, [None] * 16, 1), (5060, [float("nan")] * 16, 1), (5080, [1.0], 1), (None, rows[0][1], 1)]
    df = spark.createDataFrame(rows + odd + rows[:2], "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, 20, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 3000, 20))
    hit = 0
    for q, found in got.items():
        score = x @ x[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -score)) if i != q][:20]
        hit += len({i for i, _ in found} & set(order))
        assert len(found) == 20 and all(abs(s - score[i]) < 1e-9 for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hit >= 0.9 * 20 * len(got)
    assert [i for i, _ in got[100]] == [7, 101, 102, 103, 104, 105, 106, 107, 108, 109, 110, 111, 112, 113, 114, 115, 116, 117, 118, 119]
    few = ann.nearest(df.where("vec_id < 3"), 20, lambda i: i % 20 == 0).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] and len(few) == 2
    assert ann.nearest(df.limit(0), 20, lambda i: i % 20 == 0).count() == 0


def test_forest_prunes_clustered_vectors_and_deepens_with_their_number():
    """Candidates scored a query, as a share of all vectors, and recall; random vectors show what cannot be pruned."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(200, 64))
    clustered = centres[rng.integers(200, size=20000)] + 0.25 * rng.normal(size=(20000, 64))
    shares = {}
    for name, x in (("clustered", clustered), ("random", rng.normal(size=(4000, 64)))):
        x /= np.linalg.norm(x, axis=1)[:, None]
        forest = ann.fit_forest(x[::2], 1.0, 20, len(x))
        leaf = forest.leaves(forest.lift(x, query=False))
        hit, scored, queries = 0, 0, range(1, len(x), len(x) // 50)
        for i in queries:
            score = x @ x[i]
            score[i] = -np.inf
            near = set(np.argpartition(-score, 20)[:20].tolist())
            met = [np.flatnonzero(leaf[t] == place) for t, place in forest.search(forest.lift(x[i : i + 1], True)[0], forest.visits)]
            scored += sum(map(len, met))
            hit += len(near & set(np.concatenate(met).tolist()))
        shares[name] = scored / len(queries) / len(x)
        assert hit >= 0.9 * 20 * len(queries)
    assert shares["clustered"] < 0.08 < shares["random"] < 2
    depths = [len(ann.fit_forest(clustered[::4], 1.0, 20, rows).split[0]) for rows in (5_000, 500_000, 50_000_000)]
    assert depths == sorted(depths) and depths[0] < depths[-1]


def test_ties_of_different_vectors_go_to_smaller_ids():
    # 199 vectors that differ but have one product with the query, in no order.
    order = np.random.default_rng(1).permutation(np.arange(1, 200))
    vectors = [[1.0, *[float(i >> b & 1) for b in range(8)]] for i in order.tolist()]
    queries = pa.table({"query": [800], "vector": [[1.0] + [0.0] * 8]})
    members = pa.table({"ids": pa.array([[800 + i] for i in order.tolist()]), "vector": vectors})
    found = ann._rank_leaf(20)(None, queries, members).to_pylist()[0]
    assert found["ids"] == list(range(801, 821)) and set(found["scores"]) == {1.0}


def test_quotes_link_messages_and_go(spark):
    rows = [
        (1, 0, "user", "How are you?\nTell me more."),
        (1, 1, "assistant", "Fine, thanks."),
        (1, 2, "user", "> how are   YOU?\n> tell me more.\nNot answered."),
        (1, 3, "user", "> Not answered.\n>> How are you?\nStill not."),
        (1, 4, "user", "> nobody said this\nA new start."),
        (2, 0, None, None),
        (2, 0, None, None),
        (None, 1, "user", "> Fine, thanks.\nlost"),
        (3, None, "user", "no turn"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, thread_turn string")
    got = [tuple(r) for r in quotation_linking.format_conversations(df).orderBy("conv_id", "thread_turn", "turn").collect()]
    assert [g[:4] + g[5:7] for g in got if g[0] == 1] == [
        (1, 0, 0, None, 0, "How are you?\nTell me more."),
        (1, 0, 2, 0, 2, "Not answered."),
        (1, 0, 3, 2, 2, "Still not."),
        (1, 1, 1, None, 0, "Fine, thanks."),
        (1, 4, 4, None, 1, "A new start."),
    ]
    assert [g[4] for g in got if g[0] == 2] == ["unknown"] * 2
    assert [g[7] for g in got if g[0] == 3] == ["<|user|>\nno turn"]
    assert [g[6] for g in got if g[0] is None] == ["lost"]
    assert quotation_linking.format_conversations(df.limit(0)).count() == 0


def test_passages_are_found_however_they_are_wrapped(spark):
    first = "The first part of it speaks of\nbread, and of how bread is made\n\nThe second part has\nanother theme. It ends here!\n\nlast words"
    long = "one two three four five six seven eight nine ten eleven twelve without any full stop in all of it"
    rows = [
        (1, 0, first),
        (1, 1, long),
        (1, 2, "> the second part\n> has another theme.\n> It ends here!\nA paragraph."),
        (1, 3, "> The first part of it\n> speaks of bread, and of how bread is made\nyes\n> last\n> words\nTwo passages."),
        (1, 4, "> has another theme. It ends\n> here!\nA sentence."),
        (1, 5, "> ... four five six seven\n> eight nine ten eleven twelve [...]\nInside a line."),
        (1, 6, ">> last words\nOnly at level two."),
        (1, 7, ">> last words\n> Inside a line.\nAt both."),
        (1, 8, "> the second theme\n> has part another bread\nNobody said that."),
    ]
    df = spark.createDataFrame([(*r[:2], "user", r[2]) for r in rows], "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["parent_turn"], r["thread_turn"]) for r in quotation_linking.format_conversations(df).collect()}
    assert got == {0: (None, 0), 1: (None, 1), 2: (0, 0), 3: (0, 0), 4: (0, 0), 5: (1, 1), 6: (0, 0), 7: (5, 1), 8: (None, 8)}


def plain_links(rows):
    """(conv, turn) -> (parent, thread) of messages, by the module's docstring."""
    norm = lambda t: re.sub(r"[ \t\n\x0b\f\r]+", " ", t).strip(" ").lower()
    quote = re.compile(r"^[ \t]*(>[ \t>]*)")

    def lines(text):
        for line in (text or "").split("\n"):
            mark = quote.match(line)
            yield (mark.group(1).count(">") if mark else 0), (line[mark.end():] if mark else line)

    def units(text, level):
        parts = list(lines(text))
        some = [norm(body) for at, body in parts if at == level and norm(body)]
        runs, paragraphs = [[]], [[]]
        for at, body in parts:
            if at != level:
                runs.append([])
                paragraphs.append([])
            elif not norm(body):
                paragraphs.append([])
            else:
                runs[-1].append(norm(body))
                paragraphs[-1].append(norm(body))
        runs, paragraphs = [" ".join(r) for r in runs if r], [" ".join(p) for p in paragraphs if p]
        sentences = [s for p in paragraphs for s in re.split(r"(?<=[.!?\u2026]) +|(?<=[\u3002\uff01\uff1f]) *", p)]
        words = [" ".join(w[i : i + 8]) for w in (r.split(" ") for r in runs) for i in range(max(1, len(w) - 7))]
        return {u for u in [*some, " ".join(some), *runs, *paragraphs, *sentences, *words] if u}

    parent = {}
    by_conv = collections.defaultdict(list)
    for conv, turn, text in rows:
        by_conv[conv].append((turn, text))
    for conv, said in by_conv.items():
        first = {}
        for turn, text in sorted(said):
            for unit in units(text, 0):
                first.setdefault(unit, turn)
        for turn, text in said:
            best = {}
            for level in {at for at, _ in lines(text) if at > 0}:
                chars = collections.Counter()
                for unit in units(text, level):
                    if first.get(unit, turn) < turn:
                        chars[first[unit]] += len(unit)
                best.update({(-level, n, source): source for source, n in chars.items()})
            if best:
                parent[conv, turn] = best[max(best)]
    out = {}
    for conv, turn, _ in rows:
        top = turn
        while (conv, top) in parent:
            top = parent[conv, top]
        out[conv, turn] = (parent.get((conv, turn)), top)
    return out


def test_links_of_generated_conversations_equal_a_plain_version(spark):
    import random

    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)] + ["yes.", "No!", "why?", "Ja"]
    sentence = lambda: " ".join(rng.choices(words, k=rng.randint(1, 14))) + rng.choice([".", "!", "", "?"])
    rows = []
    for conv, length in [*((c, rng.randint(1, 7)) for c in range(25)), (99, 120)]:
        said = []
        for turn in range(length):
            own = [rng.choice(["", sentence(), sentence() + " " + sentence()]) for _ in range(rng.randint(1, 5))]
            text = []
            for _ in range(rng.randint(0, 2) if said else 0):
                passage = rng.choice(said).replace("\n", rng.choice(["\n", " "])).upper().split(" ")
                at = rng.randrange(len(passage))
                text += [rng.choice(["> ", ">> ", " >", "> >"]) + line for line in " ".join(passage[at : at + rng.randint(3, 30)]).split("\n")]
                text += rng.choice([[], [sentence()]])
            rows.append((conv, turn, "\n".join([*text, *own])))
            said.append(rows[-1][2])
    df = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = quotation_linking.format_conversations(df.repartition(3)).collect()
    want = plain_links(rows)
    assert {(r["conv_id"], r["turn"]): (r["parent_turn"], r["thread_turn"]) for r in got} == want
    assert sum(p is not None for p, _ in want.values()) > 60


def test_viterbi_equals_the_library_and_comes_back(spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    vocabulary = sentencepiece_viterbi.load()
    proto = pb.ModelProto()
    proto.ParseFromString(vocabulary.definition)
    proto.trainer_spec.model_type = 1  # score-based segmentation
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["", " ", "Hello  world", "the quick brown fox\njumps\tover", "Éçan ☃ 日本 \U0001f600", "a" * 70, "x" + " " * 20 + "y", "unbelievable internationalisation"]
    encoder = sentencepiece_viterbi.Encoder(vocabulary)
    for text in texts[2:]:
        ours, theirs = encoder.encode(text), library.encode(text)
        score = lambda ids: sum(library.get_score(i) if not library.is_byte(i) else 0 for i in ids)
        # The library adds scores in single precision, which unknown characters' large penalty uses up.
        assert ours == theirs or score(ours) >= score(theirs), text
        assert ours == list(encoder.segment(encoder.normalize(text)))
    # Characters that no piece joins are cut apart, so a text without spaces is not segmented as one long word.
    run = "日本語☃Ω" * 400 + "internationalisation" * 3
    calls, segment = [], encoder.segment
    encoder.segment = lambda part: calls.append(part) or segment(part)
    assert encoder.encode(run) == list(segment(encoder.normalize(run))) and max(map(len, calls)) <= 70
    rows = [(i, t, 1) for i, t in enumerate([*texts, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    back = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(df)).collect()
    assert all(r["decoded"] == r["text"] for r in back) and len(back) == len(rows)
    assert sentencepiece_viterbi.encode(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_ngram_jaccard_join", "op4_quality_cascade", "op11_lexical_search", "op12_line_dedup", "op13_conversation_repair"])
def test_query_equals_sql(spark, name):
    rows, problem = compare(spark, connect(SF_DIR), SF_DIR, QUERIES[name], ORACLE[name])
    assert problem is None and rows > 0


def test_pipeline_keeps_clean_rows_and_drops_copies(spark, tmp_path):
    import random

    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["ba", "do", "ki", "lu", "me", "ra"]) for _ in range(rng.randint(2, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    clean = [(i, text(80)) for i in range(60)]
    toxic = [(100 + i, text(60) + " zzvex" * 4) for i in range(40)]
    shared = text(50)
    rows = clean + toxic + [(200, clean[0][1]), (201, clean[1][1] + " more"), (202, f"{text(50)} {shared}"), (203, f"{shared} {text(50)}")]
    rows += [(204, f'{text(30)} token = "{"0a1b2c3d" * 5}" {text(30)}'), (205, None), (206, ""), (None, text(70))]
    rows += [(None, None)] * 3 + [(None, "")] * 2
    # Columns with the names that operators add.
    extra = "n_words int, score string, redacted string, `kept_text` string, predicted int, __hash long, n_secrets int"
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), -5, "x", "y", "z", 9, at, -6) for at, (i, t) in enumerate(rows)],
        f"doc_id long, text string, lang string, source string, n_chars long, {extra}",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 100)) for i, _ in clean + toxic], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {r["doc_id"]: r for r in now.collect()}
        assert now.select("n_words", "score", "redacted", "kept_text", "predicted", "n_secrets").distinct().collect() == [(-5, "x", "y", "z", 9, -6)]
        assert now.where("doc_id is null and coalesce(text, '') = ''").count() == 5
        assert stage(spark, now.limit(0), str(tmp_path)).count() == 0
    assert not [i for i in kept["toxicity"] if i is not None and 100 <= i < 140]
    assert {i for i, _ in clean} <= set(kept["near_duplicates"]) and not {200, 201} & set(kept["near_duplicates"])
    assert shared not in kept["substring_dedup"][202]["text"] and len(kept["substring_dedup"][202]["text"].split()) == 50
    assert kept["substring_dedup"][2]["text"] == clean[2][1]
    assert "[SECRET]" in kept["secrets"][204]["text"] and kept["secrets"][204]["n_chars"] == len(kept["secrets"][204]["text"])
    assert kept["secrets"][205]["text"] is None
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(kept["secrets"])
