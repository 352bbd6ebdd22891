"""Suffix sorting on many chunks and buckets: what is asked, sent and sorted."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa

from marquee.llm import suffix


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def contexts_of(raw):
    anchor, size = suffix.anchors(raw)
    return [raw[a:a + n + suffix.LENGTH - 1] for a, n in zip(np.cumsum(size) - size, size)]


def test_only_contexts_with_more_in_common_than_an_anchor_are_sorted(monkeypatch):
    # two copies of a text, a text that shares 200 bytes with it, 60 that share 30 bytes with it here and there, and one byte over and over
    r = random.Random(4)
    own = lambda n: bytes(r.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    a = own(4000)
    texts = [a, a, own(100) + a[700:900] + own(100), *(own(60) + a[60 * k:60 * k + 30] + own(60) for k in range(60)), b"x" * 90, b"y" + b"x" * 70]
    strings = [(c, 100 - k) for k, t in enumerate(texts) for c in contexts_of(t)]
    sort, sorted_bytes = suffix.smallest_ids, []

    def counted(found, ids, *rest):
        sorted_bytes.append(sum(map(len, found)))
        return sort(found, ids, *rest)
    monkeypatch.setattr(suffix, "smallest_ids", counted)
    got = suffix._answer_contexts(pd.DataFrame({
        "chunk": [0], "bucket": [0], "contexts": [b"".join(c for c, _ in strings)], "sizes": [np.array([len(c) for c, _ in strings], "<u4").tobytes()],
        "ids": [np.array([i for _, i in strings], "<i8").tobytes()], "home": [None]}))
    held, windows = {}, [(c[p:p + suffix.LENGTH], i) for c, i in strings for p in range(len(c) - suffix.LENGTH + 1)]
    for w, i in windows:
        held[w] = min(held.get(w, i), i)
    assert np.repeat(np.frombuffer(got["ids"][0], "<i8"), np.frombuffer(got["sizes"][0], "<u4")).tolist() == [held[w] for w, _ in windows]
    assert 0 < sum(sorted_bytes) < 1500, sorted_bytes


def test_a_chunk_sends_few_messages_for_many_buckets():
    raws = [words(k, 300, 5000).encode() for k in range(60)]
    runs = [np.arange(len(suffix.anchors(raw)[0]), dtype="<u4").tobytes() for raw in raws]
    ids = pa.array(range(60), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array([raw.decode() for raw in raws]), ids, pa.array(runs, pa.binary())], names=["key", "text", "id", "runs"])
    for buckets in (128, 131):
        sent = pa.Table.from_batches(suffix._ask_contexts(buckets)(iter([batch]))).to_pandas()
        assert len(sent) <= buckets / 8 + 1 and sum(h is not None for h in sent["home"]) == 1
        assert sum(len(x) for x in sent["contexts"]) == sum(len(c) for c in {c for raw in raws for c in contexts_of(raw)})


def test_copies_ask_nothing(spark, monkeypatch):
    # three copies of each text, in other tasks; a class is its first document, so no text has anything in common with another one
    texts = ["".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz ", k=600)) for k in range(40)]
    rows = [(k, texts[k % 40]) for k in range(120)]

    def none(buckets):
        def run(batches):
            for batch in batches:
                assert not batch.num_rows, "a document that only has copies is sorted"
            return iter(())
        return run
    monkeypatch.setattr(suffix, "_ask_contexts", none)
    got = suffix.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(6, "doc_id")).collect()
    assert {g["id"]: g["n_removed"] for g in got} == {k: 600 * (k >= 40) for k in range(120)}
