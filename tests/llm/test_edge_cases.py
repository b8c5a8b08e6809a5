"""Nulls, empty and very long texts, repeated rows, clashing names and empty tables, operator by operator."""

import pytest

from barloom.llm import license_scan, line_dedup, packing, quality_rules, secret_scan, sentencepiece_viterbi, substring_dedup, toxicity

LONG = "ordinary words of a very long text " * 60_000
MIT = "Permission is hereby granted, free of charge, to any person. Licensed under the Apache License, Version 2.0 (the \"License\")"
TEXTS = [None, "", " \n\t", LONG, MIT, MIT, 'password = "hunter2hunter2" and more', "Größe 日本 \u0000 end"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None)] * 2 + [(4, MIT)] * 2
    clash = "n_words int, score string, spans int, ids string, licenses int, kept_text int, n_lines string"
    return spark.createDataFrame([(*r, -1, "s", -2, "i", -3, -4, "l") for r in rows], f"doc_id long, text string, {clash}")


def scored(docs):
    labels = docs.sparkSession.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    return toxicity.score(docs, labels)


OPERATORS = {
    "substring_dedup": (substring_dedup.remove_repeated, "kept_sha256"),
    "license_scan": (license_scan.scan, "license"),
    "quality": (quality_rules.judge, "kept"),
    "sentencepiece": (lambda d: sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(d)), "decoded"),
    "toxicity": (scored, "predicted"),
    "secrets": (secret_scan.scan, "spans"),
    "lines": (line_dedup.drop_repeated_lines, "kept_text"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_come_out_alike(docs, name):
    operator, told = OPERATORS[name]
    made = operator(docs)
    rows = made.select("doc_id", told).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.select("doc_id").collect())
    assert len({r[told] for r in rows if r["doc_id"] in (4, 5)}) == 1, "repeated rows have one result"
    assert len({r[told] for r in rows if r["doc_id"] is None}) == 1
    assert operator(docs.limit(0)).count() == 0


def test_odd_texts_are_packed(docs):
    pieces = packing.pack(docs)
    rows = pieces.collect()
    assert {r["doc_id"] for r in rows} == {*range(len(TEXTS)), None}
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) > 100_000
    assert packing.pack(docs.limit(0)).count() == 0


def test_long_round_trip(docs):
    back = sentencepiece_viterbi.decode(sentencepiece_viterbi.encode(docs.where("doc_id in (3, 5)").select("doc_id", "text")))
    assert all(r["decoded"].strip() == r["text"].strip() for r in back.collect())
