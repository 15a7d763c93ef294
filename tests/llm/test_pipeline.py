"""The pipeline, stage by stage against brute force, with null and repeated ids."""

from collections import Counter, defaultdict

import public_tokenizers
from cases import passage
from test_dedup_and_join import kept_by_brute_force
from tokenizers import Tokenizer

import corpus_pipeline
from teledex.llm.exact_dedup import normalised
from teledex.llm.mixing import mix
from teledex.storage import materialize


def test_stages_equal_brute_force(spark, sf_dir):
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = " ".join(passage(i, 30) for i in range(4))
    more = [(None, text), (None, text + " tail"), (3, text + " other tail"), (3, "alone " + passage(9, 90)), (3, "alone " + passage(9, 90)), (None, None), (5, "")]
    extra = spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in more], base.schema)
    docs = base.unionByName(extra)
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"test-{name}")
        after[name] = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == before.columns
        if name == "exact_dedup":
            texts = [r.n for r in before.select(normalised(before.text).alias("n")).collect()]
            assert len(after[name]) == len(set(texts))
        if name == "mixing":
            draws = Counter(r.doc_id for r in mix(before, repetition=2.0, draws=True).collect())
            assert Counter(r["doc_id"] for r in after[name]) == draws
    rows = lambda name: [(r["doc_id"], r["text"]) for r in after[name]]
    assert set(rows("quality")) <= {(r.doc_id, r.text) for r in base.unionByName(extra).collect()}
    assert sorted(rows("near_dedup"), key=str) == kept_by_brute_force(rows("exact_dedup"), 5, 80)
    # Packing: every token of every drawn document, in sequences without gaps.
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = Counter()
    for doc_id, text in rows("mixing"):
        sizes[doc_id] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    packed, sequences = Counter(), defaultdict(list)
    for r in after["packing"]:
        packed[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert packed == sizes
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
