"""Training-data operators against brute-force versions, exact round trips and held-out accuracy, with edge cases."""

import gzip
import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from compare import database, same
from sluice.llm import audio, common, lattice, licenses, merkle, neardup, packing, quality, queries, tokens, tokenstore, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [
    (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "a", None, "s", 1), (4, "the quick brown fox jumps over the lazy dog", "en", None, 43),
    (5, "the quick brown fox jumps over the lazy dog", "en", "s", 43), (5, "the quick brown fox jumps over the lazy dog", "en", "s", 43),
    (6, "été\n\nübér 梦😀  x\t y <|endoftext|>", "fr", "s", 30), (7, "word " * 30_000, "en", "s", 150_000), (None, "no id here at all", "en", "s", 17),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.withColumns({c: F.lit(9) for c in ("score", "kept", "length", "start", "sequence_id", "_bucket", "h", "fingerprint", "id", "g", "n_bytes")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(sf):
    return pd.read_parquet(f"{sf}/documents.parquet").sort_values("doc_id")


def plain_ids(text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_vocabulary())
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# -- packing and token files ------------------------------------------------------------------------------------------


def check_packed(rows, texts):
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), Counter())[(r.start, r.length, r.ids_crc32)] += 1
    for doc_id, text in texts.items():
        ids = plain_ids(text, 1)
        pieces = by_doc[(doc_id, len(ids))]
        want = Counter((s, len(ids[s : s + 2048]), crc(ids[s : s + 2048])) for s in range(0, len(ids), 2048))
        assert set(pieces) == set(want)
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * len(windows))


def test_packing_is_exact_and_tight(spark, sf, docs):
    rows = queries.op1_packing(spark, sf).collect()
    assert check_packed(rows, dict(zip(docs.doc_id, docs.text))) > 0.98  # 84 windows of 200 documents


def test_packing_edge_cases(edge, empty):
    rows = packing.pack_documents(edge).collect()
    check_packed(rows, {i: t for i, t, *_ in EDGE})
    assert sum(r.doc_id == 5 for r in rows) == 2 and packing.pack_documents(empty).count() == 0


def test_window_plans_use_every_piece_once():
    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = {int(k): int(n) for k, n in zip(rng.choice(np.arange(1, 65), 30, False), rng.integers(1, 400, 30))}
        used = Counter()
        for lengths, n in packing.plan_windows(counts, 64):
            assert sum(lengths) <= 64 and n > 0
            for v in lengths:
                used[v] += n
        assert used == Counter(counts)
    assert packing.plan_windows({}, 64) == []


def test_token_files(spark, sf, docs, edge, empty):
    rows = queries.op5_token_store(spark, sf).orderBy("doc_id").collect()
    start = 0
    for r, text in zip(rows, docs.text):
        ids = plain_ids(text, 0)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(rows) == len(docs)
    back = tokenstore.store_and_read(edge).orderBy("start").collect()
    assert back[0].doc_id is None and [r.doc_id for r in back][1:] == [1, 2, 3, 4, 5, 5, 6, 7]
    assert {r.doc_id: r.n_tokens for r in back}[2] == 1 and tokenstore.store_and_read(empty).count() == 0
    path = common.fresh_path(spark, "tokens")
    tokenstore.write_tokens(tokenstore.encode_documents(edge), path)
    assert "ids" not in tokenstore.read_tokens(spark, path, ids=False).columns


def test_added_tokens_get_their_own_ids(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_vocabulary())
    texts = ["a<|endoftext|>b", "x  <|endoftext|>  y", "<|endoftext|><|endoftext|>", " <|endoftext|>\n it's", "a <|endoftext| > <|endoftext|", "plain words", "<|endoftext|>"]
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    bpe = tokens.byte_bpe(tokens.default_vocabulary())
    assert [np.frombuffer(bpe.encode(t), "<u4").tolist() for t in texts] == ids and ids[0] == [64, 50256, 65]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = tokenstore.store_and_read(df).orderBy("doc_id").collect()
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in stored] == [(sum(len(x) + 1 for x in ids[:k]), len(i) + 1, crc([*i, 0])) for k, i in enumerate(ids)]
    packed = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.pack_documents(df).collect()}
    assert packed == {k: (len(i) + 1, crc([*i, 1])) for k, i in enumerate(ids)}


# -- classifiers ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("query, label, least", [(queries.op2_quality, "quality", 0.9), (queries.op7_toxicity, "toxic", 0.85)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    got = query(spark, sf).toPandas().set_index("doc_id")
    truth = pd.read_parquet(f"{sf}/labels.parquet").set_index("doc_id")[label]
    both = got.join(truth, how="inner")
    held = both[both.held_out]
    assert got.score.between(0, 1).all() and (held.predicted == held[label]).mean() >= least
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.index]).all()


def test_scores_of_edge_cases_and_no_labels(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for module, f in ((quality, quality.quality_scores), (toxicity, toxicity.toxicity_scores)):
        rows = f(edge, none).collect()
        assert len(rows) == len(EDGE) and all(r.score == 0.5 for r in rows)
        assert f(empty, none).count() == 0
    some = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(1, 8)], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(edge, some).count() == len(EDGE) == toxicity.toxicity_scores(edge, some).count()
    kept = quality.score(edge, quality.fit([], 0.7), "score")
    assert kept.columns == edge.columns and kept.count() == len(EDGE)


def test_toxicity_learns_words_and_pairs():
    rows = [(f"w{k} w{k + 1} awful thing w{k + 2}", 1) for k in range(200)] + [(f"w{k} awful w{k + 1} thing w{k + 2} fine", 0) for k in range(200)]
    model = toxicity.fit(rows, 0.5)
    assert model.score("x awful thing y") > 0.8 and model.score("x awful y thing fine") < 0.2
    assert 0 < len(model.slots) < 1000


# -- sampled segmentations --------------------------------------------------------------------------------------------


def all_segmentations(p, text):
    def of_word(word):
        out = []

        def go(i, path, lw):
            if i == len(word):
                out.append((tuple(path), lw))
                return
            single = False
            for k in range(1, min(p.longest, len(word) - i) + 1):
                j = p.model.piece_to_id(word[i : i + k])
                if p.model.id_to_piece(j) == word[i : i + k] and p.log_weight[j] > -np.inf:
                    go(i + k, [*path, j], lw + p.log_weight[j])
                    single |= k == 1
            if not single:
                spelled = [p.bytes[b] for b in word[i].encode()]
                go(i + 1, path + spelled, lw + p.byte_weight * len(spelled))

        go(0, [], 0.0)
        z = np.logaddexp.reduce([w for _, w in out])
        return {s: w - z for s, w in out}

    whole = {(): 0.0}
    for word in text.split(" "):
        whole = {a + b: x + y for a, x in whole.items() for b, y in of_word(lattice.MARK + word).items()}
    return whole


def test_samples_follow_the_exact_distribution():
    p = lattice.pieces(lattice.default_model())
    exact = all_segmentations(p, "an it\n")
    n = 4000
    got = lattice.sample_texts(p, ["an it\n"] * n, [lattice.row_key(k, 7) for k in range(n)], 3)
    for many in got:
        assert len({tuple(s[3].tolist()) for s in many}) == 3 and many[0][1] > many[1][1] > many[2][1]
        assert all(abs(exact[tuple(s[3].tolist())] - s[0]) < 1e-9 for s in many)
    best = max(exact, key=exact.get)
    share = sum(tuple(m[0][3].tolist()) == best for m in got) / n
    assert abs(share - math.exp(exact[best])) < 0.03
    weighted = np.mean([sum(math.exp(s[0]) / s[2] for s in m) for m in got])
    assert abs(weighted - 1) < 0.02  # inclusion scores make sums over the sample unbiased
    few = lattice.sample_texts(p, ["a"], [1], 50)[0]
    assert len(few) == len(all_segmentations(p, "a")) and abs(sum(math.exp(s[0]) for s in few) - 1) < 1e-9


def is_path(p, text, ids):
    """Whether the ids are a path of the text's lattice."""
    chunks, at = p.chunks(text), 0
    chart = lattice.Lattice(p, chunks)
    for node in chart.root:
        while node >= 0:
            for e in range(chart.first[node], chart.first[node + 1]):
                piece = p.ids(chart.kind[e : e + 1], np.zeros(0, int))[0].tolist()
                if ids[at : at + len(piece)] == piece:
                    node, at = chart.to[e], at + len(piece)
                    break
            else:
                return False
    return at == len(ids)


def test_space_runs_are_in_the_lattice():
    p = lattice.pieces(lattice.default_model())
    for text in ("    x = 1", "if a:\n        b  =   c\n", "a   b", " a", "  ", " ", "a    ", "\tx   | é  梦", "word" + " " * 40 + "word", "a▁ b", "plain words here"):
        assert is_path(p, text, p.model.encode(text)), text
    text = "a   b"
    exact = {}

    def go(rest, path, lw):
        if not rest:
            exact[tuple(path)] = lw
        for k in range(1, len(rest) + 1):
            j = p.model.piece_to_id(rest[:k])
            if p.model.id_to_piece(j) == rest[:k]:
                go(rest[k:], [*path, j], lw + p.log_weight[j])

    go("▁" + text.replace(" ", "▁"), [], 0.0)
    total = np.logaddexp.reduce(list(exact.values()))
    got = lattice.sample_texts(p, [text], [1], 500)[0]
    assert {tuple(s[3].tolist()) for s in got} == set(exact) and tuple(p.model.encode(text)) in exact
    assert all(abs(exact[tuple(s[3].tolist())] - total - s[0]) < 1e-9 for s in got)


def test_samples_decode_to_their_texts(spark, sf, docs, edge, empty):
    rows = queries.op3_sentencepiece(spark, sf)
    assert rows.count() == sum(2 if t else 1 for t in docs.text)
    back = lattice.decode(rows).distinct().toPandas()
    assert dict(zip(back.doc_id, back.text)) == dict(zip(docs.doc_id, docs.text)) and len(back) == len(docs)
    first = {(r.doc_id, r["sample"]): (r.ids, r.inclusion) for r in rows.limit(50).collect()}
    again = lattice.sample(spark.read.parquet(f"{sf}/documents.parquet").repartition(3))
    assert all((r.ids, r.inclusion) == first.get((r.doc_id, r["sample"]), (r.ids, r.inclusion)) for r in again.collect())
    got = lattice.sample(edge).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in EDGE} and all(r.ids == [] for r in got if r.doc_id in (1, 2))
    assert lattice.sample(empty).count() == 0
    plain = lattice.decode(lattice.encode(edge.filter("doc_id = 6"))).first()
    assert plain.text == EDGE[6][1]


# -- audio ------------------------------------------------------------------------------------------------------------


def test_audio_round_trip(spark, sf, docs, edge, empty):
    rows = {r.doc_id: r for r in queries.op4_audio(spark, sf).collect()}
    seen = {}
    for i, text in zip(docs.doc_id, docs.text):
        data = text.encode()
        pay = data + b"\xff" * (max(1, -(-len(data) // 576)) * 576 - len(data))
        r = rows[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-32:]))
        assert r.media_sha256 == hashlib.sha256(audio.wav(pay)).hexdigest() and r.media_bytes == len(audio.wav(pay))
        assert seen.setdefault(text, r.feature) == r.feature
    got = {r.doc_id: r for r in audio.store_and_describe(edge).collect()}
    assert got[1].payload_bytes == 576 and got[1].feature == got[2].feature and got[4].feature == got[5].feature
    assert audio.store_and_describe(empty).count() == 0


def test_resampling_equals_the_direct_form():
    rng = np.random.default_rng(0)
    for up, down, n in ((1, 2, 301), (3, 2, 100), (2, 3, 77), (1, 1, 9), (5, 4, 3), (1, 2, 1)):
        x, h = rng.standard_normal(n).astype(np.float32), audio.lowpass(up, down)
        spread = np.zeros(n * up)
        spread[::up] = x
        direct = np.concatenate([np.convolve(spread, h), np.zeros(8 * down)])[(len(h) - 1) // 2 :: down][: -(-n * up // down)]
        assert np.allclose(audio.resample(x, up, down), direct, atol=1e-5)


def test_hysteresis_and_tensors(spark, tmp_path):
    level = np.array([-30, 0, -8, -8, 0, -30, -8, -30, 0, -30], float)
    assert audio.active_spans(level + 13.6 - level.mean() - 13.6) == audio.active_spans(level)
    quiet = np.array([0.0] * 5 + [-40.0] * 5 + [0.0] * 5)
    assert audio.active_spans(quiet - 0) == [(0, 5), (10, 15)]
    tone = (128 + 100 * np.sin(np.arange(16000) * 0.3)).astype(np.uint8)
    media = audio.wav(np.concatenate([tone, np.full(16000, 128, np.uint8), tone]).tobytes())
    n, spans, tensors = audio.describe(media)
    assert len(spans) == 2 and abs(spans[0]["end_s"] - 1.0) < 0.05 and abs(spans[1]["start_s"] - 2.0) < 0.05
    array = audio.tensor_array(tensors)
    assert array.to_numpy_ndarray().shape == (len(tensors), audio.FRAMES, audio.MELS)
    df = spark.createDataFrame([(1, 3, bytearray(media)), (2, 0, None)], "doc_id long, n_bytes long, media binary")
    made = common.written(audio.write_tensors(audio.features(df).drop("media"), f"file://{tmp_path}/t"), "tensor-files")
    assert sum(r.rows for r in made.collect()) == 2
    stored = [r for f in made.collect() for r in pa.ipc.open_file(f.file).read_all().to_pylist()]
    one = next(r for r in stored if r["doc_id"] == 1)
    assert [(s["start_s"], s["end_s"]) for s in one["spans"]] == [(s["start_s"], s["end_s"]) for s in spans]
    kind = pa.ipc.open_file(made.first().file).schema.field("tensors").type.value_type
    assert kind == pa.fixed_shape_tensor(pa.float16(), (audio.FRAMES, audio.MELS)) and len(one["tensors"]) == len(tensors)
    back = audio.read_tensors(made, f"file://{tmp_path}/t", audio.digested, "doc_id long, n_bytes long, feature string").collect()
    h = hashlib.sha256(b"".join(struct.pack("<ddi", s["start_s"], s["end_s"], s["tensors"]) for s in spans) + b"".join(tensors)).hexdigest()
    assert {r.doc_id: r.feature for r in back} == {1: f"{n}:2:{len(tensors)}:{h}", 2: f"0:0:0:{hashlib.sha256().hexdigest()}"}


def slow_log_mel(y, rate):
    """Log-mel frames and energies from the definitions: a discrete Fourier transform and triangles, bin by bin."""
    width, hop = int(audio.FRAME_SECONDS * rate), int(audio.HOP_SECONDS * rate)
    y = np.concatenate([y, np.zeros(max(0, width - len(y)))])
    bins = np.arange(audio.FFT // 2 + 1)
    wave = np.exp(-2j * np.pi * np.outer(np.arange(width), bins) / audio.FFT)
    top = 2595 * math.log10(1 + rate / 2 / 700)
    edges = [700 * (10 ** (top * k / (audio.MELS + 1) / 2595) - 1) / rate * audio.FFT for k in range(audio.MELS + 2)]
    mel, energy = [], []
    for a in range(0, len(y) - width + 1, hop):
        part = (y[a : a + width] - y[a : a + width].mean()) * (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(width) / (width - 1)))
        power = np.abs(part @ wave) ** 2
        energy.append(10 * math.log10((part**2).sum() / width + 1e-10))
        mel.append([10 * math.log10(sum(power[b] * max(0.0, min((b - lo) / (mid - lo), (hi - b) / (hi - mid))) for b in bins) + 1e-10) for lo, mid, hi in zip(edges, edges[1:], edges[2:])])
    return np.array(mel), np.array(energy)


def slow_spans(energy):
    """Hysteresis, frame by frame."""
    spans, start = [], None
    for k, e in enumerate(energy - energy.mean()):
        if start is None and e >= audio.START_DB:
            start = k
        elif start is not None and e < audio.STOP_DB:
            spans.append((start, k))
            start = None
    return spans + ([(start, len(energy))] if start is not None else [])


def test_features_equal_slow_versions():
    rng = np.random.default_rng(8)
    for n in (10, 400, 5000, 9000):
        y = (rng.standard_normal(n) * np.repeat(rng.choice([0.001, 0.3], n // 10 + 1), 10)[:n]).astype(np.float32)
        mel, energy = audio.log_mel(y, audio.TARGET_RATE)
        want, loud = slow_log_mel(y.astype(float), audio.TARGET_RATE)
        assert mel.shape == want.shape and np.abs(mel - want).max() < 0.05 and np.abs(energy - loud).max() < 0.01
        assert audio.active_spans(energy) == slow_spans(energy)
    for _ in range(200):
        level = rng.choice([-40.0, -8.0, 0.0, -13.0], 30)
        assert audio.active_spans(level) == slow_spans(level)


# -- WARC -------------------------------------------------------------------------------------------------------------


def test_warc_revisits_and_pushed_headers(spark, sf, empty):
    same(queries.op6_warc(spark, sf), database(sf), queries.oracle_sql()["op6_warc"])
    pages = spark.createDataFrame(
        [(1, "http://a/x", "same"), (2, "http://a/y", "same"), (9, "http://b/\r\nz", "same"), (3, None, None), (4, "http://c", ""), (5, "u", "é" * 40_000), (5, "u", "é" * 40_000), (None, "n", "same")],
        "page_id long, url string, html string",
    )
    got = {(r.page_id, r.record_type): r for r in warc.archive_and_read(pages).collect()}
    assert got[(1, "revisit")].refers_to == 9 and got[(2, "revisit")].payload_bytes == 4 and (9, "response") in got
    assert got[(3, "revisit")].refers_to == 4 and got[(5, "response")].payload_bytes == 80_000
    assert warc.archive_and_read(pages).count() == 8 and warc.archive_and_read(pages.limit(0)).count() == 0
    path = common.fresh_path(spark, "warc")
    warc.write_warc(warc.to_records(pages, least_bytes=5), path)
    files = [f for f in os.listdir(common.local_path(path)) if f.endswith(".warc.gz")]
    plain = b"".join(gzip.open(f"{common.local_path(path)}/{f}").read() for f in files)  # gzip alone, once
    assert plain.count(b"WARC/1.1\r\n") == pages.count()
    heads = warc.read_warc(spark, path, payload=False)
    assert heads.filter("record_type = 'revisit'").count() == 0  # smaller payloads are all responses
    one = warc.read_warc(spark, path).filter("record_type = 'response' AND target_uri LIKE 'http://a/%'")
    assert sorted(bytes(r.payload) for r in one.collect()) == [b"same", b"same"]
    assert heads.filter("target_uri = 'u'").first().payload is None


def test_unwanted_payloads_are_not_inflated():
    import io

    rows = [{"record_id": f"<urn:page:{k}>", "record_type": t, "target_uri": "u", "warc_date": "d", "payload_digest": "x", "refers_to": None, "http_length": None, "payload": b"p" * 100_000} for k, t in enumerate(["response", "request"])]
    data = b"".join(warc.member(warc.record_bytes(r)) for r in rows)
    spoiled = bytearray(data)
    first = len(warc.member(warc.record_bytes(rows[0])))
    spoiled[first - 20 : first - 8] = b"\xff" * 12  # damage in the payload of the record that nobody asks for
    got = list(warc.read_members(io.BytesIO(bytes(spoiled)), lambda c: c["record_type"] == "request"))
    assert len(got) == 1 and got[0]["payload"] == b"p" * 100_000
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_members(io.BytesIO(bytes(spoiled))))


def test_ordinary_archives_are_read(spark, tmp_path):
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nContent-Type: application/warc-fields\r\nContent-Length: 14\r\n\r\nsoftware: x\r\n\n\r\n\r\n"
    rows = [{"record_id": f"<urn:page:{k}>", "record_type": t, "target_uri": f"http://u/{k}", "warc_date": "d", "payload_digest": "x", "refers_to": None, "http_length": None, "payload": bytes([65 + k]) * n} for k, (t, n) in enumerate([("response", 100_000), ("request", 0), ("response", 5), ("response", 3_000_000)])]
    records = [info, *map(warc.record_bytes, rows)]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))  # a member per record, no lengths
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(records)))  # one member for all
    (tmp_path / "d.warc.gz").write_bytes(b"".join(map(warc.member, records)))
    (tmp_path / "e.warc").write_bytes(b"")
    for payload in (True, False):
        df = warc.read_warc(spark, str(tmp_path), payload)
        for part in (df, df.filter("record_type = 'response' AND target_uri LIKE 'http://u/%'"), df.filter("record_type = 'warcinfo'")):
            got = Counter((r.record_id, r.http_length, r.payload and bytes(r.payload)) for r in part.collect())
            assert got and set(got.values()) == {4}
    whole = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert all(bytes(whole[r["record_id"]].payload) == r["payload"] and whole[r["record_id"]].http_length == len(r["payload"]) for r in rows)
    assert bytes(whole["<urn:i>"].payload) == b"software: x\r\n\n" and len(whole) == 5
    (tmp_path / "f.warc").write_bytes(records[1][:5000])
    with pytest.raises(Exception, match="ends within"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_common_payloads_are_no_join_key(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr("CASE WHEN id % 2 = 0 THEN 'error page' WHEN id % 5 = 0 THEN NULL ELSE concat('p', id % 1400) END").alias("html"))
    want = {}
    for r in pages.collect():
        want.setdefault(r.html or "", []).append(r.page_id)
    newest = {i: max(ids) for ids in want.values() for i in ids}
    got = warc.archive_and_read(pages).collect()
    assert len(got) == 3000 and all((r.refers_to or r.page_id) == newest[r.page_id] and (r.record_type == "revisit") == (newest[r.page_id] != r.page_id) for r in got)


# -- near-duplicates --------------------------------------------------------------------------------------------------


def brute_components(texts, words, percent):
    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    where = {}
    for i in ids:
        shared = Counter(j for s in sets[i] for j in where.get(s, ()))
        for s in sets[i]:
            where.setdefault(s, []).append(i)
        for j, k in shared.items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, sf, docs):
    rows = queries.op8_near_duplicates(spark, sf).collect()
    want = brute_components(dict(zip(docs.doc_id, docs.text)), 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_of_one_large_group(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(260):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 14), False):
            words[at] = f"x{rng.integers(10**9)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame([(int(i), t) for i, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, 3, 85).collect()}
    assert got == brute_components(texts, 3, 85)


def test_near_duplicates_edge_cases(edge, empty):
    rows = neardup.near_duplicates(edge).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGE) and got[5].component_id == 4 and not got[5].kept and got[4].kept
    assert got[1].n_shingles == 0 and got[1].component_id == 1 and got[2].component_id == 2 and got[3].n_shingles == 1
    assert got[None].kept and got[None].component_id is None and got[7].n_shingles == 1
    stay = neardup.deduplicate(edge)
    assert stay.columns == edge.columns and stay.filter("doc_id = 5").count() == 0
    assert neardup.near_duplicates(empty).count() == 0 and neardup.deduplicate(empty).count() == 0


def test_repeated_rows_are_linked_once(spark):
    base = " ".join(f"w{k}" for k in range(200))
    other = base + " more words here"
    rows = [(1, base)] * 120 + [(2, other)] * 120 + [(3, base)] * 5 + [(4, "apart from all the others")] + [(4, base)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}  # 4 has the links of both its texts
    nodes = spark.createDataFrame([(7, 1, neardup.set_key(next(neardup.shingle_sets(pa.array([base]), 5))))], "node long, rep long, set_key binary")
    assert neardup.node_texts(spark.createDataFrame(rows, "doc_id long, text string"), nodes, 5).count() == 1


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 140)}}


# -- fingerprints -----------------------------------------------------------------------------------------------------


def test_fingerprints_equal_their_sql(spark, sf):
    same(queries.op9_fingerprints(spark, sf), database(sf), queries.oracle_sql()["op9_fingerprints"])


def test_fingerprint_edge_cases(spark, edge, empty):
    rows = merkle.fingerprint_edits(edge).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(EDGE) and got[1].fingerprint == got[2].fingerprint and got[4].fingerprint == got[5].fingerprint
    assert got[1].n_chars == 0 and got[1].near_edited == 1.0 and got[4].near_next == 1.0
    cut = EDGE[7][1]
    assert got[7].edited_sha256 == hashlib.sha256((cut[: len(cut) - len(cut) // 4] + EDGE[8][1][: len(cut) // 4]).encode()).hexdigest()  # the last one's next is the first: the null id
    assert merkle.fingerprint_edits(empty).count() == 0
    one = merkle.fingerprint_edits(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_likeness_has_no_length_switch_and_follows_insertions(spark):
    rng = np.random.default_rng(5)
    text = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(400))
    pairs = [(text[:n], text[: n - n // 5]) for n in (100, 250, 300, 320, 2000)]  # the lengths on both sides of any switch
    pairs += [(text[:900], "X" + text[:900]), (text[:900], text[:450] + " new " + text[450:900])]  # one line, text inserted
    pairs += [(text[:600], text[1200:1800]), ("", text[:300]), ("", "")]
    df = spark.createDataFrame(pairs, "l string, r string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "l", "a"), "r", "b").withColumn("near", merkle.likeness("a", "b"))
    near = [r.near for r in df.collect()]
    assert all(n >= 0.7 for n in near[:5]) and all(n >= 0.9 for n in near[5:7]) and near[7] < 0.2 and near[8:] == [0.0, 1.0]


@pytest.mark.parametrize("ids", [lambda k: k if k else 2**60, lambda k: None if k % 3 else k, lambda k: 7 if k % 2 else -k, lambda k: hash((k, 1)) % 2**62])
def test_ranges_hold_about_equal_rows_in_order(spark, ids):
    rows = [(ids(k), f"text {k}") for k in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.coalesce("doc_id", F.lit(-(2**63)))).withColumn("tie", F.xxhash64("text"))
    got = sorted((r.id, r.tie, r.g) for r in merkle.with_groups(df).collect())
    assert [g for *_, g in got] == sorted(g for *_, g in got)
    sizes = Counter(g for *_, g in got)
    assert len(got) == 20_000 and len(sizes) >= 7 and max(sizes.values()) <= 2 * merkle.ROWS_PER_GROUP + 500


def test_next_crosses_ranges_and_hot_ids(spark):
    rows = [(None if k % 3 == 0 else 5 if k % 3 == 1 else k * 10**12, f"{k} text") for k in range(15_000)]
    doc = spark.createDataFrame(rows, "id long, text string").withColumn("id", F.coalesce("id", F.lit(-(2**63)))).withColumn("tie", F.xxhash64("text"))
    got = sorted((r.id, r.tie, r.text, r.next_text) for r in merkle.with_next(doc).select("id", "tie", "text", "next_text").collect())
    texts = [t for _, _, t, _ in got]
    assert len(got) == 15_000 and [n for *_, n in got] == texts[1:] + texts[:1]


def test_changed_paragraphs_are_located(spark):
    left = "\n".join(f"paragraph {k}" for k in range(40))
    right = left.replace("paragraph 17", "new words here").replace("paragraph 30\n", "")
    pair = spark.createDataFrame([(left, right), ("same", "same"), (None, "x")], "l string, r string")
    got = [(r.left_changed, r.right_changed) for r in merkle.changed_paragraphs(pair, "l", "r").collect()]
    assert got[0] == ([17, 30], [17]) and got[1] == ([], []) and got[2][1] == [0]


def test_fingerprints_use_no_python(spark, sf):
    plan = queries.op9_fingerprints(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


LICENSES = {name: re.sub("[{}]", "", text) for name, text in licenses.TEMPLATES.items()}


# -- licenses ---------------------------------------------------------------------------------------------------------


def test_alignment_is_a_common_subsequence_with_anchors():
    rng = np.random.default_rng(3)
    for _ in range(50):
        b = [f"w{k}" for k in rng.integers(0, 30, 20)]
        a = [w for w in b if rng.random() < 0.8]
        a = [x for w in a for x in ([w, f"n{rng.integers(9)}"] if rng.random() < 0.2 else [w])]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert licenses.align("a b c d".split(), "a b c d".split()) == [(k, k) for k in range(4)]
    assert len(licenses.ascending([(0, 3), (1, 1), (2, 2), (3, 0), (4, 5)])) == 3


def test_license_scan(spark, sf, docs, edge, empty):
    rows = queries.op10_licenses(spark, sf).collect()
    lines = {v: k for k, v in LICENSES.items() if len(v) < 90}
    want = Counter((i, lines[l]) for i, t in zip(docs.doc_id, docs.text) for l in t.split("\n") if l in lines)
    assert want and Counter((r.doc_id, r.license) for r in rows) == want
    assert all(r.coverage >= licenses.COVERAGE for r in rows)
    mit = LICENSES["MIT text"]
    changed = mit.replace("to any person", "to any honest person").replace("sublicense, ", "")
    text = "intro words " * 50 + changed + " tail words" * 50 + "\n" + LICENSES["MIT"]
    df = spark.createDataFrame([(1, text), (2, "licensed to fish"), (3, None)], "doc_id long, text string")
    found = licenses.scan(df).orderBy("start_char").collect()
    assert [r.license for r in found] == ["MIT text", "MIT"] and text[found[1].start_char : found[1].end_char] == "Released under the MIT License"
    assert text[found[0].start_char :].startswith("Permission is hereby") and found[0].coverage < 1
    assert licenses.scan(edge).count() == 0 and licenses.scan(empty).count() == 0


def names(text):
    return [m[0] for m in licenses.matches(text, licenses.prepared(licenses.TEMPLATES))]


def test_repeated_notices_give_a_row_each():
    for name, line in LICENSES.items():
        for n in (2, 3, 7):
            assert names(" ".join([line] * n)) == [name] * n and names(" x\n".join([line] * n)) == [name] * n
    mit = LICENSES["MIT text"]
    one = mit.replace("to any person", "to any honest person").replace("sublicense, ", "").replace("the following conditions", "these conditions")
    two = mit.replace("free of charge", "at no cost").replace("portions of the Software", "parts of it")
    for parts in ((one, one), (one, two), (two, one), (two, two), (one, mit, two)):
        assert names("\n".join(parts)) == ["MIT text"] * len(parts)
    assert names("All rights reserved. Released under the MIT License. All rights reserved.") == ["Reserved", "MIT", "Reserved"]


def edited(text, rng, share):
    """The text with a share of its words replaced, left out or followed by another word."""
    out = []
    for w in text.split():
        r = rng.random()
        out += [w] if r >= share else [[f"new{rng.integers(99)}"], [], [w, "so"]][rng.integers(3)]
    return " ".join(out)


def every_range(words, template):
    """Notices by aligning all ranges of words, densest first."""
    n, found = len(template.words), []
    for a in range(len(words)):
        for b in range(a + template.need, min(len(words), a + template.longest) + 1):
            if words[a] in template.count and words[b - 1] in template.count:
                k = licenses.notice(words, a, b, template)
                found += [(-2 * k / (b - a + n), a, b, k)] if k else []
    out = []
    for _, a, b, k in sorted(found):
        if all(b <= c or a > d for c, d, _ in out):
            out.append((a, b - 1, k))
    return sorted(out)


@pytest.mark.parametrize("name, folds", [("MIT text", 3), ("GPL header", 6), ("ISC text", 8), ("LGPL-2.1 header", 4), ("BSD text", 5), ("Reserved", 200), ("GPL-3.0", 200), ("ISC text", 200)])
def test_notices_equal_all_ranges(name, folds):
    rng = np.random.default_rng(folds)
    template = next(t for t in licenses.prepared(licenses.TEMPLATES) if t.license == name)
    for share in (0.0, 0.05, 0.12, 0.25) if folds < 200 else (0.02,):
        parts = [edited(LICENSES[name], rng, share) for _ in range(folds)]
        texts = [" ".join(parts)]
        if folds < 200:
            half = len(parts[0]) // 2
            texts += [" and then ".join(parts), parts[0][:half] + " " + parts[1] + " " + parts[0][half:], " ".join(rng.permutation(texts[0].split()))]
        for text in texts:
            words = [w for w, _, _ in licenses.words_of(text)]
            assert licenses.notices(words, template) == every_range(words, template)


def test_many_adjacent_edited_notices_are_all_found():
    rng = np.random.default_rng(60)
    ready = licenses.prepared(licenses.TEMPLATES)
    for name in ("MIT text", "GPL header", "Apache-2.0 header", "BSD-3-Clause full text"):
        parts = []
        while len(parts) < 60:
            text = edited(LICENSES[name], rng, 0.06)
            parts += [text] if names(text) == [name] else []
        for between in (" ", " " + "other words between " * 70):
            assert [m[0] for m in licenses.matches(between.join(parts), ready)] == [name] * 60


def test_near_miss_notices_are_not_named():
    gpl, agpl = LICENSES["GPL header"], LICENSES["AGPL-3.0 header"]
    for text in (
        "Released under the BSD License.", "released under the new license", "Licensed under CC BY 4.0.", "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU General Public License, version 2.", "This library is licensed under the GNU General Public License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "Released under the modified MIT License.", "Released under the MIT style License.", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC 3.0.",
        gpl.replace("GNU General", "GNU Free General"), gpl.replace("GNU General Public", "Affero General Public"), gpl.replace("version 3", "version 4"), gpl.replace("version 3", "version 2.1"),
        gpl.replace("version 3 of", "version 2 or 3 of"), agpl.replace("version 3", "version 1"), gpl.replace("Public License as", "Public Documentation License as"),
    ):
        assert names(text) == [], text
    assert all(names(text) == [name] for name, text in LICENSES.items())
    # other licenses' headers have their own names
    assert names(gpl.replace("GNU General", "GNU Lesser General")) == names(gpl.replace("This program", "This library").replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0 header"]
    assert names(gpl.replace("GNU General", "GNU Affero General")) == ["AGPL-3.0 header"] and names(gpl.replace("version 3", "version 2")) == ["GPL-2.0 header"]
    assert names(gpl.replace("This program", "This library")) == ["GPL header"] and names("All of the rights are reserved.") == ["Reserved"]


def test_one_very_long_cluster_is_read_in_linear_time(spark):
    import time

    rng = np.random.default_rng(5)
    text = " ".join(edited(LICENSES["MIT text"], rng, 0.05) for _ in range(300))
    began = time.time()
    found = licenses.scan(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, license string")).collect()
    assert len(found) >= 295 and time.time() - began < 30
    assert all(text[r.start_char : r.end_char].strip() and r.license == "MIT text" for r in found)


# -- pipeline ---------------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_stages_by_hand(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    q, t = quality.fit_model(docs, labels), toxicity.fit_model(docs, labels)
    texts = {i: x for i, x in texts.items() if q.score(x or "") >= quality.THRESHOLD}
    texts = {i: x for i, x in texts.items() if t.score(x or "") < toxicity.THRESHOLD}
    texts = {i: texts[i] for i, (_, c) in brute_components(texts, 5, 80).items() if c == i}
    check_packed(corpus_pipeline.run(spark, sf).collect(), texts)
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()} == set(texts)


def test_pipeline_stages_on_edge_cases(spark, sf, edge, empty):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, edge, sf).columns == edge.columns
        assert stage(spark, empty, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf).count() == 0
