"""Audio columns: 8-bit WAV media, and log-mel features as fixed-shape tensors with time spans.

`store` turns bytes into WAV files kept in a media column; `features` reads the media back, resamples by a polyphase
filter, computes overlapped log-mel frames, finds active spans by hysteresis on the frame energy and cuts each span
into tensors of one fixed shape (FRAMES x MELS, float16, zero-padded at a span's end). `write_tensors` stores them in
Arrow files as fixed-shape tensors beside their spans, `read_tensors` reads these.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ship import ship
from .common import doc_texts, filesystem, fresh_path, slices, written

#: Payload bytes come in multiples of this, filled up with FILL.
BLOCK, FILL = 576, 255
RATE, TARGET_RATE = 16_000, 8_000
FILTER_TAPS = 32
#: Media bytes described at once: tensors take about six times as many.
MEDIA_BYTES = 2 << 20
FRAME_SECONDS, HOP_SECONDS, FFT = 0.025, 0.010, 256
MELS, FRAMES = 40, 32
#: A span starts where a frame is at least START_DB and ends where it falls below STOP_DB, relative to the mean energy.
START_DB, STOP_DB = -6.0, -12.0
_RIFF = struct.Struct("<4sI4s4sIHHIIHH4sI")

FEATURES = "doc_id long, n_bytes long, media binary, n_frames long, spans array<struct<start_s:double,end_s:double,tensors:int>>, tensors array<binary>"


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file of unsigned 8-bit samples."""
    pad = b"\0" * (len(samples) % 2)
    return _RIFF.pack(b"RIFF", 36 + len(samples) + len(pad), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples)) + samples + pad


def wav_samples(media: bytes) -> tuple[bytes, int]:
    """Samples and rate of an 8-bit mono WAV file; chunks other than fmt and data are passed over."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, RATE
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("only mono 8-bit samples are read")
        elif name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no samples")


@functools.lru_cache(maxsize=8)
def lowpass(up: int, down: int) -> np.ndarray:
    """Windowed-sinc filter for a rate change by up / down, FILTER_TAPS taps per unit of the larger factor."""
    wide = max(up, down)
    n = FILTER_TAPS * wide // 2 + 1
    t = np.arange(n) - (n - 1) / 2
    return (up * np.sinc(t / wide) / wide * np.hanning(n + 2)[1:-1]).astype(np.float32)


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """Polyphase change of the sampling rate by up / down: only samples that are kept are computed."""
    h = lowpass(up, down)
    delay = (len(h) - 1) // 2
    n_out = -(-len(x) * up // down)
    y = np.zeros(n_out, np.float32)
    for j in range(min(up, n_out)):
        t = j * down + delay
        g, base = h[t % up :: up], t // up
        k = -(-(n_out - j) // up)
        for r in range(min(down, len(g))):
            part = g[r::down]
            first = base - r - (len(part) - 1) * down  # y[k] = sum_q part[q] * x[base - r + down * (k - q)]
            need = k + len(part) - 1
            index0 = max(0, -(first // down)) if first < 0 else 0
            taken = x[first + index0 * down :: down][: max(0, need - index0)]
            line = np.zeros(need, np.float32)
            line[index0 : index0 + len(taken)] = taken
            y[j::up] += np.convolve(line, part, "valid")
    return y


@functools.lru_cache(maxsize=4)
def mel_bank(rate: int) -> np.ndarray:
    """Triangular filters, FFT bins x MELS, evenly spaced on the mel scale from 0 to half the rate."""
    mel = np.linspace(0, 2595 * np.log10(1 + rate / 2 / 700), MELS + 2)
    edge = (700 * (10 ** (mel / 2595) - 1)) / rate * FFT
    bins = np.arange(FFT // 2 + 1)[:, None]
    rise, fall = (bins - edge[:-2]) / (edge[1:-1] - edge[:-2]), (edge[2:] - bins) / (edge[2:] - edge[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


def log_mel(y: np.ndarray, rate: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel frames in dB (frames x MELS) and each frame's energy in dB; a short signal is one padded frame."""
    width, hop = int(FRAME_SECONDS * rate), int(HOP_SECONDS * rate)
    if len(y) < width:
        y = np.pad(y, (0, width - len(y)))
    frames = np.lib.stride_tricks.sliding_window_view(y, width)[::hop]
    window, bank = np.hanning(width).astype(np.float32), mel_bank(rate)
    out, energy = [], []
    for i in range(0, len(frames), 2048):
        part = frames[i : i + 2048]
        part = (part - part.mean(axis=1, keepdims=True)) * window
        energy.append(10 * np.log10(np.einsum("ij,ij->i", part, part) / width + np.float32(1e-10)))
        spectrum = np.fft.rfft(part, FFT, axis=1)
        power = spectrum.real**2 + spectrum.imag**2
        out.append(10 * np.log10(power.astype(np.float32) @ bank + np.float32(1e-10)))
    return np.concatenate(out), np.concatenate(energy)


def active_spans(energy: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) frame spans: from a frame at START_DB or above to before the next one below STOP_DB."""
    level = energy - energy.mean()
    mark = np.where(level >= START_DB, 1, np.where(level < STOP_DB, -1, 0))
    settled = np.flatnonzero(mark)
    if not len(settled):
        return []
    state = np.zeros(len(mark), int)
    state[settled] = mark[settled]
    last = np.maximum.accumulate(np.where(state != 0, np.arange(len(state)), -1))
    on = np.where(last >= 0, state[last] > 0, False)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(int), [0]])))
    return [(int(a), int(b)) for a, b in edge.reshape(-1, 2)]


def describe(media: bytes) -> tuple[int, list[dict], list[bytes]]:
    """Frames, spans in seconds and tensors (FRAMES x MELS float16, little-endian, in tenths of a dB) of a WAV file."""
    samples, rate = wav_samples(media)
    x = (np.frombuffer(samples, np.uint8).astype(np.float32) - 128) / 128
    common = int(np.gcd(rate, TARGET_RATE))
    mel, energy = log_mel(resample(x, TARGET_RATE // common, rate // common), TARGET_RATE)
    spans, tensors = [], []
    for a, b in active_spans(energy):
        n = -(-(b - a) // FRAMES)
        block = np.zeros((n * FRAMES, MELS), "<f2")
        block[: b - a] = np.round(mel[a:b], 1)
        size = FRAMES * MELS * 2
        data = block.tobytes()
        tensors += [data[i * size : (i + 1) * size] for i in range(n)]
        spans.append({"start_s": a * HOP_SECONDS, "end_s": (b - 1) * HOP_SECONDS + FRAME_SECONDS, "tensors": n})
    return len(mel), spans, tensors


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the text's UTF-8 bytes, filled up to a positive multiple of BLOCK, as a WAV file.

    Null text: empty, one block of fill. Repeated rows are kept; other columns are left out.
    """
    def run(batches):
        for batch in slices(batches):
            data = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            media = [wav(d + bytes([FILL]) * (max(1, -(-len(d) // BLOCK)) * BLOCK - len(d))) for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, data), pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"]
            )

    return doc_texts(docs).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def features(media: DataFrame) -> DataFrame:
    """media (doc_id, n_bytes, media) with n_frames, spans and tensors; null media has no frame."""
    ship(media.sparkSession)

    def run(batches):
        for batch in slices(batches, "media", MEDIA_BYTES):
            found = [describe(m) if m is not None else (0, [], []) for m in batch.column("media").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), batch.column("media"), pa.array([f[0] for f in found], pa.int64()),
                 pa.array([f[1] for f in found], pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64()), ("tensors", pa.int32())]))),
                 pa.array([f[2] for f in found], pa.list_(pa.binary()))],
                ["doc_id", "n_bytes", "media", "n_frames", "spans", "tensors"],
            )

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)


def tensor_array(tensors: list[bytes]) -> pa.FixedShapeTensorArray:
    """Tensors of one fixed shape as an Arrow extension array."""
    flat = np.frombuffer(b"".join(tensors), "<f2")
    kind = pa.fixed_shape_tensor(pa.float16(), (FRAMES, MELS))
    return pa.ExtensionArray.from_storage(kind, pa.FixedSizeListArray.from_arrays(pa.array(flat), FRAMES * MELS))


def write_tensors(described: DataFrame, path: str) -> DataFrame:
    """Write one Arrow file per task: every row with its columns, the spans in seconds and a list of fixed-shape tensors
    for them; returns (file, rows).

    Files of failed attempts are in no row of the result, so a reader takes the files listed there, once the result is written.
    """
    ship(described.sparkSession)

    def run(batches):
        store, folder = filesystem(path)
        store.create_dir(folder, recursive=True)
        name, n, writer = f"{folder}/tensors-{uuid.uuid4().hex}.arrow", 0, None
        with store.open_output_stream(name) as out:
            for batch in batches:
                tensors = batch.column("tensors")
                ends = tensors.offsets.to_numpy() - tensors.offsets[0].as_py()
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), tensor_array(tensors.flatten().to_pylist()))
                kept = [c for c in batch.schema.names if c != "tensors"]
                rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], [*kept, "tensors"])
                writer = writer or pa.ipc.new_file(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                writer.write_batch(rows)
                n += batch.num_rows
            if writer:
                writer.close()
        if writer:
            yield pa.RecordBatch.from_pydict({"file": [name], "rows": [n]})

    return described.mapInArrow(run, "file string, rows long")


def read_tensors(files: DataFrame, path: str, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """each over the record batches of written tensor files (file), a task per file. path is the folder they are in."""
    ship(files.sparkSession)

    def run(batches):
        store, _ = filesystem(path)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                with store.open_input_file(name) as source:
                    stored = pa.ipc.open_file(source)
                    for k in range(stored.num_record_batches):
                        yield each(stored.get_batch(k))

    return files.select("file").repartition(max(1, files.count())).mapInArrow(run, schema)


def digested(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A batch of a tensor file with feature in place of frames, spans and tensors: their numbers and a hash of all."""
    tensors = batch.column("tensors")
    kind = tensors.type.value_type
    if kind.shape != [FRAMES, MELS]:
        raise ValueError(f"tensors of shape {kind.shape}")
    flat = tensors.values.storage.flatten().to_numpy(zero_copy_only=False)
    offsets, size = tensors.offsets.to_numpy(), FRAMES * MELS
    out = []
    for k, (n, spans) in enumerate(zip(batch.column("n_frames").to_pylist(), batch.column("spans").to_pylist())):
        a, b = int(offsets[k]), int(offsets[k + 1])
        h = hashlib.sha256(b"".join(struct.pack("<ddi", s["start_s"], s["end_s"], s["tensors"]) for s in spans))
        h.update(flat[a * size : b * size].astype("<f2", copy=False).tobytes())
        out.append(f"{n}:{len(spans)}:{b - a}:{h.hexdigest()}")
    kept = [c for c in batch.schema.names if c not in ("n_frames", "spans", "tensors")]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out)], [*kept, "feature"])


def store_and_describe(docs: DataFrame) -> DataFrame:
    """Store every text as WAV in the shared folder, read it back, store its features as tensors with time spans, read
    those back, and digest media and features per document."""
    spark = docs.sparkSession
    path, tensors = fresh_path(spark, "media"), fresh_path(spark, "tensors")
    to_media(docs).write.option("compression", "zstd").parquet(path)
    described = features(spark.read.schema("doc_id long, n_bytes long, media binary").parquet(path))
    payload = F.substring("media", _RIFF.size + 1, 2**31 - 1)
    rows = described.withColumn("payload", payload).select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -32, 32)).alias("tail_crc32"), F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), "n_frames", "spans", "tensors",
    )
    files = written(write_tensors(rows, tensors), "tensor-files")
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return read_tensors(files, tensors, digested, schema)
