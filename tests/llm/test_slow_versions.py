"""Scorers, buckets, samples and file formats against slow versions written from their definitions."""

import math
import re

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from sluice.llm import common, lattice, neardup, packing, quality, queries, tokens, tokenstore, toxicity, warc
from test_llm import EDGE, all_segmentations, edge, empty  # noqa: F401 - fixtures

MOD = 1 << 64


def tables(spark, sf):
    return common.read(spark, sf, "documents"), common.read(spark, sf, "labels")


def test_op2_scores_equal_plain_compression(spark, sf):
    docs, labels = tables(spark, sf)
    model = quality.fit_model(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op2_quality(spark, sf).collect():
        data = texts[r.doc_id].encode()
        parts = [data[i : i + quality.BLOCK_BYTES] for i in range(0, len(data), quality.BLOCK_BYTES)] or [b""]
        under = []
        for dictionary in (model.bad, model.good):
            c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False)
            under.append(sum(len(c.compress(p)) for p in parts))
        b, g = under
        n, short, small = len(data), 1 / (1 + len(data) / 64), min(under) / (len(data) + 16)
        x = [1.0, (b - g) / (b + g), (b - g) / (n + 16), small, short, (b - g) / (b + g) * short, small * short, max(0.0, 0.25 - small)]
        z = sum(w * v for w, v in zip(model.weights, x))
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
        assert r.predicted == int(r.score >= 0.7)


def plain_slots(text):
    """Hashed words, pairs and skip-pairs of a text, by Python's integers."""
    h = [xxhash.xxh3_64_intdigest(w) for w in re.findall(r"\w+", text.lower())]
    pair = [(a * int(toxicity._PAIR) % MOD ^ b) * int(toxicity._MIX) % MOD for a, b in zip(h, h[1:])]
    skip = [(a * int(toxicity._SKIP) % MOD ^ b) * int(toxicity._MIX) % MOD for a, b in zip(h, h[2:])]
    return {x >> (64 - toxicity.HASH_BITS) for x in h + pair + skip}


def test_op7_scores_equal_plain_sums(spark, sf):
    docs, labels = tables(spark, sf)
    model = toxicity.fit_model(docs, labels)
    weights = dict(zip(model.slots.tolist(), np.asarray(model.weights, np.float32).astype(float).tolist()))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in queries.op7_toxicity(spark, sf).collect():
        z = model.intercept + sum(weights.get(s, 0.0) for s in plain_slots(texts[r.doc_id]))
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-6 and r.predicted == int(r.score >= 0.3)


def test_weights_equal_ftrl_by_coordinates():
    rng = np.random.default_rng(4)
    rows = [(" ".join(f"w{k}" for k in rng.integers(0, 40, 12)) + (" awful thing" if k % 2 else " fine day"), k % 2) for k in range(120)]
    model = toxicity.fit(rows, 0.5)
    z, n = {}, {}
    bias = bias_n = 0.0
    by_class = [[plain_slots(t) for t, y in rows if y == k] for k in (0, 1)]
    weight = lambda i: 0.0 if abs(z.get(i, 0.0)) <= toxicity.L1 else -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)
    for _ in range(toxicity.EPOCHS):
        for j in range(60):
            for y in (0, 1):
                found = by_class[y][j]
                w = {i: weight(i) for i in found}
                g = 1 / (1 + math.exp(-max(-30, min(30, bias + sum(w.values()))))) - y
                for i in found:
                    old = n.get(i, 0.0)
                    z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w[i]
                    n[i] = old + g * g
                bias_n += g * g
                bias -= toxicity.ALPHA / (toxicity.BETA + bias_n**0.5) * g
    kept = {i: weight(i) for i in z if abs(z[i]) > toxicity.L1}
    assert dict(zip(model.slots.tolist(), np.round(model.weights, 6).tolist())) == {i: pytest.approx(w, abs=1e-5) for i, w in kept.items()}
    assert kept and model.intercept == pytest.approx(bias, abs=1e-6)


@pytest.mark.parametrize("percent, common_of_20", [(85, 17), (80, 16)])
def test_bands_meet_pairs_at_the_threshold(percent, common_of_20):
    rng = np.random.default_rng(percent)
    rows, missed, tried = neardup.band_rows(percent), 0, 0
    for union, pairs in ((20, 6000), (200, 2000), (1500, 150)):
        both = union * common_of_20 // 20
        for _ in range(pairs):
            values = np.unique(rng.integers(0, 2**64, union + 8, dtype=np.uint64))[:union]
            values = rng.permutation(values)
            only = values[both:]
            a, b = np.concatenate([values[:both], only[::2]]), np.concatenate([values[:both], only[1::2]])
            missed += not set(neardup.bucket_keys(a, rows)) & set(neardup.bucket_keys(b, rows))
            tried += 1
    assert missed <= 2 and tried == 8150  # 2e-5 of the pairs, were the values independent


def test_token_files_have_the_encodings_and_indexes(spark, sf, tmp_path):
    docs = common.read(spark, sf, "documents")
    path = f"{tmp_path}/tokens"
    tokenstore.write_tokens(tokenstore.encode_documents(docs), path)
    files = [p for p in (tmp_path / "tokens").iterdir() if p.name.endswith(".parquet")]
    seen = 0
    for file in files:
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            for c in range(group.num_columns):
                column = group.column(c)
                encodings = set(column.encodings)
                if column.path_in_schema.startswith("ids"):
                    assert "RLE_DICTIONARY" in encodings
                else:
                    assert "DELTA_BINARY_PACKED" in encodings and not encodings & {"RLE_DICTIONARY", "PLAIN_DICTIONARY"}
                assert column.has_column_index and column.has_offset_index
                seen += 1
    assert seen >= 5
    plan = tokenstore.read_tokens(spark, path, ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan  # metadata alone is read


def test_sampled_columns_equal_all_segmentations(spark):
    p = lattice.pieces(lattice.default_model())
    texts = ["an it\n", "a", "the", "it is", "été", "x"]
    rows = lattice.sample(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).collect()
    for k, text in enumerate(texts):
        exact, own = all_segmentations(p, text), sorted((r for r in rows if r.doc_id == k), key=lambda r: r["sample"])
        assert len({tuple(r.ids) for r in own}) == len(own) == min(4, len(exact))
        assert all(abs(exact[tuple(r.ids)] - r.log_prob) < 1e-9 and r.n_pieces == len(r.ids) for r in own)
        assert [r["sample"] for r in own] == list(range(1, len(own) + 1)) and all(a.perturbed > b.perturbed for a, b in zip(own, own[1:]))
        if len(exact) <= 4:
            assert all(r.inclusion == 1 for r in own)
        else:
            assert all(0 < r.inclusion <= 1 for r in own)
    many = lattice.sample(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("an it\n").alias("text")), 3).toPandas()
    total = (np.exp(many.log_prob) / many.inclusion).groupby(many.doc_id).sum()
    assert abs(total.mean() - 1) < 0.03  # inclusion scores make sums over a sample unbiased


def test_clashing_columns_of_pages_and_labels(spark, sf):
    docs, labels = tables(spark, sf)
    more = labels.withColumns({c: F.lit(3) for c in ("text", "y", "h", "score", "held_out", "lang")})
    for module, f in ((quality, quality.quality_scores), (toxicity, toxicity.toxicity_scores)):
        plain = {r.doc_id: r.score for r in f(docs, labels).collect()}
        assert {r.doc_id: r.score for r in f(docs, more).collect()} == plain
    pages = common.read(spark, sf, "pages").limit(20)
    wide = pages.withColumns({c: F.lit("z") for c in ("payload", "digest", "record_type", "refers_to", "payload_bytes", "headers")})
    assert sorted(map(tuple, warc.archive_and_read(wide).collect())) == sorted(map(tuple, warc.archive_and_read(pages).collect()))


def test_packing_stage_on_edge_rows(spark, sf, edge, empty):  # noqa: F811
    import corpus_pipeline

    packed = corpus_pipeline.pack_windows(spark, edge, sf).collect()
    sizes = {}
    for r in packed:
        sizes.setdefault(r.doc_id, set()).add(r.doc_tokens)
    ids = tokens.default_vocabulary()
    from tokenizers import Tokenizer

    count = lambda t: len(Tokenizer.from_file(ids).encode(t or "", add_special_tokens=False).ids) + 1
    assert sizes == {i: {count(t)} for i, t, *_ in EDGE}
    for sequence in {r.sequence_id for r in packed}:
        at = 0
        for r in sorted((r for r in packed if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert corpus_pipeline.pack_windows(spark, empty, sf).count() == 0 and packing.pack_documents(empty).count() == 0
    assert pd.isna(next((r.doc_id for r in packed if r.doc_id is None), None))
