"""SentencePiece encoding, decoding and sampling of distinct segmentations without replacement.

A text's segmentations form a lattice that is cut before every run of space marks: pieces hold marks at their start
only, or are runs of marks, so none crosses such a cut. Pieces weigh 1 / (rank + 2)^POWER by their rank in the model, and
a backward pass turns the weights into exact probabilities of the next piece at every node.

Sampling is Gumbel top-k by perturbed A-star search. The whole lattice gets a Gumbel value, its maximum, and a sampled
path that attains it. Taking that path out splits the rest into disjoint regions - same pieces up to some point, another
piece there, anything after - whose maxima are Gumbel values truncated at the parent's. The best region is opened next,
so paths come out distinct and in descending perturbed order; the value of the best unopened region is the threshold of
the inclusion scores. All steps run over many documents at once in numpy; every random number is a hash of the row key,
the path's number and the place in the text, so results don't depend on batches or partitions.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

from ..plans.ship import ship
from .common import doc_texts, slices, worker_cache

SAMPLES = 2
POWER = 0.5
SEED = 20_240
MARK = "▁"
#: Bytes of text whose lattices are worked on at once: more texts share more words. One longer text is worked on whole.
BYTES_AT_ONCE = 1 << 20
#: Fixed-point units of log probabilities and probabilities.
LOG_UNIT, P_UNIT = 2.0**40, 2**52

SAMPLED = "doc_id long, sample int, log_prob double, perturbed double, inclusion double, n_pieces long, ids array<int>"

_K = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


_chunk = re.compile(f"{MARK}+[^{MARK}]*")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, stream: int, place: np.ndarray, step: int = 0) -> np.ndarray:
    """In (0, 1), by seed, path number, place and step alone."""
    with np.errstate(over="ignore"):
        x = seed + np.uint64(stream * 1_000_003 + step * 7_919 + 1) * _K
        x = mixed(x) + place.astype(np.uint64) * _K
    return ((mixed(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Pieces:
    """The model's pieces by hash of their characters, with weights; characters without a piece fall back to bytes."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        self.first_virtual = n
        self.bytes = {i: self.model.piece_to_id(f"<0x{i:02X}>") for i in range(256)}
        self.log_weight = np.full(n, -np.inf)
        usable = {}
        for i in range(n):
            if self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i):
                continue
            usable[self.model.id_to_piece(i)] = i
        #: False for a model with a piece that has a mark after another character: its texts are not cut at all.
        self.cuts = not any(MARK in piece.lstrip(MARK) for piece in usable)
        for rank, i in enumerate(sorted(usable.values(), key=lambda i: (-self.model.get_score(i), i))):
            self.log_weight[i] = -POWER * np.log(rank + 2)
        self.byte_weight = -POWER * np.log(len(usable) + 2)
        self.longest = max(map(len, usable))
        prefixes = {p[:k]: usable.get(p[:k], -1) for p in usable for k in range(1, len(p) + 1)}
        self.bits = 20
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -2, np.int32)
        self.probes = 1
        for text, value in prefixes.items():
            h = np.zeros(1, np.uint64)
            for c in text:
                h = self.extend(h, np.array([ord(c)], np.uint64))
            slot, tries = int(h[0]) >> (64 - self.bits), 1
            while self.keys[slot]:
                slot, tries = (slot + 1) % (1 << self.bits), tries + 1
            self.keys[slot], self.values[slot] = h[0], value
            self.probes = max(self.probes, tries)
        self.virtual: dict[str, int] = {}
        self.expansion: list[list[int]] = []

    def chunks(self, text: str) -> list[str]:
        """The text cut before every run of space marks, each chunk without its first mark."""
        if not text:
            return []
        if self.cuts and "  " not in text and text[0] != " " and MARK not in text:
            return text.split(" ")
        text = text.replace(" ", MARK)
        return [c[1:] for c in _chunk.findall(MARK + text)] if self.cuts else [text]

    @staticmethod
    def extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h ^ c) * _K
        return h ^ (h >> np.uint64(29))

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Piece id, -1 for a mere prefix, -2 for neither."""
        slot = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.keys[slot] == h
        out = np.where(found, self.values[slot], np.int32(-2))
        open_ = np.flatnonzero(~found & (self.keys[slot] != 0))
        for k in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + k) % (1 << self.bits)
            hit = self.keys[at] == h[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.keys[at] != 0)]
        return out

    def fallback(self, char: str) -> int:
        """Virtual id of a character spelled in bytes."""
        if char not in self.virtual:
            self.virtual[char] = self.first_virtual + len(self.expansion)
            self.expansion.append([self.bytes[b] for b in char.encode("utf-8", "replace")])
        return self.virtual[char]

    def ids(self, edges: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Model ids of lattice ids, virtual ones spelled out, and where places in the one row are in the other."""
        extra = np.flatnonzero(edges >= self.first_virtual)
        spelled = [self.expansion[int(v) - self.first_virtual] for v in edges[extra]]
        more = np.array([len(s) - 1 for s in spelled], np.int64)
        out = edges.copy()
        out[extra] = [s[0] for s in spelled]
        out = np.insert(out, np.repeat(extra + 1, more), [i for s in spelled for i in s[1:]])
        return out, bounds + np.concatenate([[0], np.cumsum(more)])[np.searchsorted(extra, bounds)]


def pieces(path: str) -> Pieces:
    """One model per worker process and file."""
    return worker_cache(f"pieces {path}", lambda: Pieces(path))


class Lattice:
    """Next-piece probabilities at every node of distinct chunks. Nodes are numbered by their distance to the end."""

    def __init__(self, p: Pieces, chunks: list[str]):
        text = "".join(MARK + c for c in chunks)
        chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        sizes = np.fromiter((len(c) + 1 for c in chunks), np.int64, len(chunks))
        ends = np.cumsum(sizes)
        end = np.repeat(ends.astype(np.int32), sizes)
        here, h = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), np.uint64)
        start, stop, kind = [], [], []
        for size in range(1, p.longest + 1):
            inside = here + size <= end[here]
            here, h = here[inside], h[inside]
            if not len(here):
                break
            h = p.extend(h, chars[here + size - 1])
            v = p.look_up(h)
            hit = v >= 0
            start.append(here[hit])
            stop.append(here[hit] + size)
            kind.append(v[hit])
            if size == 1:
                bare = here[~hit]
                start.append(bare)
                stop.append(bare + 1)
                kind.append(np.fromiter((p.fallback(text[i]) for i in bare), np.int32, len(bare)))
            go = v > -2
            here, h = here[go], h[go]
        distance = end - np.arange(len(chars))
        short = distance.max(initial=0) < 2**16
        by_distance = np.argsort(distance.astype(np.uint16) if short else distance, kind="stable")
        rank = np.empty(len(chars), np.int32)
        rank[by_distance] = np.arange(len(chars), dtype=np.int32)
        # a node has at most one edge per length: edges go straight to their places, the longest piece first
        degree = np.zeros(len(chars), np.int32)
        for at in start:
            degree[rank[at]] += 1
        first = np.concatenate([[0], np.cumsum(degree)])
        free = first[1:].copy()
        self.kind = np.empty(first[-1], np.int32)
        node, to = np.empty(first[-1], np.int32), np.empty(first[-1], np.int32)
        for at, goes, v in zip(start, stop, kind):
            here = rank[at]
            free[here] -= 1
            place = free[here]
            self.kind[place], node[place] = v, here
            to[place] = np.where(goes == end[at], -1, rank[np.minimum(goes, len(chars) - 1)])
        table = np.concatenate([p.log_weight, [p.byte_weight * len(x) for x in p.expansion]])
        weight = table[self.kind]
        beta = np.zeros(len(chars) + 1)  # the last stands for the end of a chunk, -1
        steps = np.searchsorted(distance[by_distance], np.arange(1, int(distance.max(initial=0)) + 2))
        for a, b in zip(steps[:-1], steps[1:]):
            e0, e1 = first[a], first[b]
            value = weight[e0:e1] + beta[to[e0:e1]]
            at = first[a:b] - e0
            most = np.maximum.reduceat(value, at)
            beta[a:b] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, np.diff(first[a : b + 1]))), at))
        log_p = weight + beta[to] - beta[node]
        # whole numbers: sums over a batch are exact, so no value depends on what else is in it
        self.log_q = np.rint(log_p * LOG_UNIT).astype(np.int64)
        self.p_q = np.rint(np.exp(log_p) * P_UNIT).astype(np.int64)
        total = np.cumsum(self.p_q)
        self.reach = total - np.concatenate([[0], total])[first[:-1]][node]  # within the node; its last edge takes what rounding leaves
        self.reach[first[1:] - 1] = 2 * P_UNIT
        self.first, self.to, self.node = first, to, node
        self.degree = np.repeat(degree, degree)  # choices at an edge's node
        self.root = rank[ends - sizes]

    def walk(self, at: np.ndarray, seed: np.ndarray, place: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled edges from each node to the end of its chunk: (which start, edge), in order."""
        who, step = np.arange(len(at)), 0
        length = np.zeros(len(at), np.int64)
        found, edges = [], []
        while len(who):
            u = (uniform(seed[who], stream, place[who], step) * P_UNIT).astype(np.int64)
            e = self.first[at]
            more = np.flatnonzero(u >= self.reach[e])
            while len(more):
                e[more] += 1
                more = more[u[more] >= self.reach[e[more]]]
            found.append(who)
            edges.append(e)
            length[who] += 1
            at = self.to[e]
            go = np.flatnonzero(at >= 0)
            who, at, step = who[go], at[go], step + 1
        begin = np.cumsum(length) - length
        out = np.empty(int(length.sum()), np.int64)
        for k, (w, e) in enumerate(zip(found, edges)):
            out[begin[w] + k] = e
        return np.repeat(np.arange(len(length)), length), out


def truncated(mass: np.ndarray, u: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Gumbel values of the given log masses, truncated at limits."""
    return -np.logaddexp(-limit, np.log(-np.log(u)) - mass)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... sizes[0] of them, then those of starts[1], and so on."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def cut_texts(p: Pieces, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct chunks of texts, the number of each chunk in a row, and where the chunks of each text start and how many."""
    odd = pc.match_substring_regex(texts, f"^ |  |{MARK}|^$").to_numpy(zero_copy_only=False) | (not p.cuts)
    plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
    cut = pc.split_pattern(texts.take(pa.array(plain)), " ")
    others = [p.chunks(t) for t in texts.take(pa.array(rest)).to_pylist()]
    flat = pa.concat_arrays([cut.flatten(), pa.array([c for cs in others for c in cs], pa.string())]).dictionary_encode()
    order = np.concatenate([plain, rest])
    count, start = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    count[order] = np.concatenate([np.diff(cut.offsets.to_numpy()), np.array([len(cs) for cs in others], np.int64)])
    start[order] = np.cumsum(count[order]) - count[order]
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), start, count


def sample_texts(p: Pieces, texts: list[str], keys: list[int], samples: int) -> list[list[tuple[float, float, float, np.ndarray]]]:
    """For every text up to `samples` distinct segmentations: (log probability, perturbed value, inclusion, ids)."""
    which, *columns, ids, bounds = sample_arrays(p, pa.array(texts, pa.string()), keys, samples)
    out: list[list] = [[] for _ in texts]
    for k, (d, *values) in enumerate(zip(which.tolist(), *(c.tolist() for c in columns))):
        out[d].append((*values, ids[bounds[k] : bounds[k + 1]]))
    return out


def sample_arrays(p: Pieces, texts: pa.Array, keys: list[int], samples: int) -> tuple[np.ndarray, ...]:
    """Up to `samples` distinct segmentations of every text, in order: which text, log probability, perturbed value,
    inclusion score, and the ids of all in a row with their bounds."""
    distinct, number, start, n_words = cut_texts(p, texts)
    seeds = np.array(keys, np.uint64)
    top = -np.log(-np.log(uniform(seeds, 0, np.zeros(len(texts)))))
    if not distinct:
        n = len(texts)
        return np.arange(n), np.zeros(n), top, np.ones(n), np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    lattice = Lattice(p, distinct)
    first, root = lattice.first, lattice.root[number]
    kept: list[list] = [[] for _ in texts]  # (log probability, perturbed, path's place, its length) before the threshold is known
    heaps: list[list] = [[] for _ in texts]  # open regions: (-perturbed, path number, branching point, that path's place, barred edges)
    pool, pool_of = np.zeros(0, np.int64), np.zeros(0, np.int64)  # edges of all paths found, and the words they belong to
    jobs = [(d, float(top[d]), 0, 0, ()) for d in np.flatnonzero(n_words).tolist()]  # (document, perturbed, path's place, edges kept, barred)
    for r in range(1, samples + 1):
        if not jobs:
            break
        doc, value, place, t0 = (np.array(x) for x in list(zip(*jobs))[:4])
        barred = [j[4] for j in jobs]
        seed, word, opened = seeds[doc], np.zeros(len(jobs), np.int64), np.zeros(len(jobs), np.int64)
        chosen = np.full(len(jobs), -1)
        lost = np.zeros(len(jobs), np.int64)  # probability of the barred edges
        if r > 1:  # every job branches: another edge than the barred ones at its branching node
            edge = np.array([b[0] for b in barred])
            node, word = lattice.node[edge], pool_of[place + t0]
            degree = first[node + 1] - first[node]
            choices, of_job = ragged(first[node], degree), np.repeat(np.arange(len(jobs)), degree)
            bars, bar_job = np.array([e for b in barred for e in b]), np.repeat(np.arange(len(jobs)), [len(b) for b in barred])
            bar_at = np.cumsum(degree)[bar_job] - degree[bar_job] + bars - first[node[bar_job]]
            weight = np.maximum(lattice.p_q[choices], 1)
            weight[bar_at] = 0
            np.add.at(lost, bar_job, lattice.p_q[bars])
            total = np.add.reduceat(weight, np.cumsum(degree) - degree)
            u = uniform(seed, r, t0, 1_000)
            sums = np.cumsum(weight)
            base = sums[np.cumsum(degree) - 1] - total
            chosen = choices[np.searchsorted(sums, base + np.minimum((u * total).astype(np.int64), total - 1), side="right")]
            opened = (lattice.to[chosen] >= 0).astype(np.int64)
        after = np.where(chosen >= 0, word + 1, 0)
        sizes = n_words[doc] - after
        nodes, at = np.empty(int((sizes + opened).sum()), np.int64), np.empty(int((sizes + opened).sum()), np.int64)
        begin = np.cumsum(sizes + opened) - sizes - opened
        nodes[begin[opened > 0]], at[begin[opened > 0]] = lattice.to[chosen[opened > 0]], word[opened > 0]
        rest = ragged(begin + opened, sizes)
        nodes[rest], at[rest] = root[ragged(start[doc] + after, sizes)], ragged(after, sizes)
        owner = np.repeat(np.arange(len(jobs)), sizes + opened)
        found, edges = lattice.walk(nodes, seed[owner], at, r)
        new = np.bincount(owner[found], minlength=len(jobs))
        # the whole path: edges kept, the chosen one, those walked
        branch = (chosen >= 0).astype(np.int64)
        length = t0 + branch + new
        begin = np.cumsum(length) - length
        path, path_of = np.empty(int(length.sum()), np.int64), np.empty(int(length.sum()), np.int64)
        head, source = ragged(begin, t0), ragged(place, t0)
        path[head], path_of[head] = pool[source], pool_of[source]
        one = (begin + t0)[branch > 0]
        path[one], path_of[one] = chosen[branch > 0], word[branch > 0]
        tail = ragged(begin + t0 + branch, new)
        path[tail], path_of[tail] = edges, at[found]
        log_q = lattice.log_q[path]
        sums = np.cumsum(log_q)
        base = np.concatenate([[0], sums])[begin]
        here = len(pool)
        for d, g, total, b, n in zip(doc.tolist(), value.tolist(), (sums[begin + length - 1] - base).tolist(), begin.tolist(), length.tolist()):
            kept[d].append((total / LOG_UNIT, g, here + b, n))
        pool, pool_of = np.concatenate([pool, path]), np.concatenate([pool_of, path_of])
        # split what is left of each region along its path
        split, of_job = ragged(begin + t0, length - t0), np.repeat(np.arange(len(jobs)), length - t0)
        edge = path[split]
        gone = lattice.p_q[edge]
        lead = np.cumsum(length - t0) - (length - t0)
        gone[lead] += lost
        taken = np.ones(len(split), np.int64)
        taken[lead] += [len(b) for b in barred]
        degree = lattice.degree[edge]
        real = np.flatnonzero((degree > taken) & (gone < P_UNIT))
        split, of_job = split[real], of_job[real]
        mass = (sums[split] - log_q[split] - base[of_job]) / LOG_UNIT + np.log1p(-gone[real] / P_UNIT)
        t = split - begin[of_job]
        g = truncated(mass, uniform(seed[of_job], 100 + r, t), value[of_job])
        edges_of = np.flatnonzero(np.diff(of_job, prepend=-1))
        for _ in range(samples - r + 1 if len(real) else 0):  # the best ones of each region are all that can be opened
            best = np.maximum.reduceat(g, edges_of)
            hit = np.flatnonzero(g == np.repeat(best, np.diff(np.append(edges_of, len(g)))))
            hit = hit[np.diff(of_job[hit], prepend=-1) > 0]
            for j, tt, e, v, b in zip(of_job[hit].tolist(), t[hit].tolist(), path[split[hit]].tolist(), g[hit].tolist(), begin[of_job[hit]].tolist()):
                if v > -np.inf:
                    heapq.heappush(heaps[jobs[j][0]], (-v, r, tt, here + b, (*barred[j], e) if tt == t0[j] else (e,)))
            g[hit] = -np.inf
        next_jobs = []
        if r < samples:
            for d in doc.tolist():
                if heaps[d]:
                    v, _, tt, b, bars = heapq.heappop(heaps[d])
                    next_jobs.append((d, -v, b, tt, bars))
        jobs = next_jobs
    rows = []
    for d in range(len(texts)):
        limit = -heaps[d][0][0] if heaps[d] else -np.inf
        rows += [(d, lp, value, limit, b, n) for lp, value, b, n in kept[d]] or [(d, 0.0, top[d], -np.inf, 0, 0)]
    which, lp, value, limit, begin, length = (np.array(c) for c in zip(*rows))
    inclusion = np.where(np.isfinite(limit), -np.expm1(-np.exp(np.minimum(lp - np.where(np.isfinite(limit), limit, 0), 700.0))), 1.0)
    ends = np.cumsum(length)
    ids, bounds = p.ids(lattice.kind[pool[ragged(begin, length)]], np.concatenate([[0], ends]))
    return which, lp, value, inclusion, ids, bounds


def row_key(doc_id: int | None, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{doc_id}", seed=seed)


def sample(docs: DataFrame, samples: int = SAMPLES, seed: int = SEED, model: str | None = None) -> DataFrame:
    """One row per document and sampled segmentation: doc_id, sample (1 is best), log_prob, perturbed, inclusion,
    n_pieces, ids.

    The segmentations of a document are distinct; where it has fewer than `samples`, all of them come out, with
    inclusion 1. Null or empty text: one empty segmentation of probability 1. Rows equal in doc_id and text give equal
    samples. Other columns are left out.
    """
    path = model or default_model()

    def run(batches):
        p = pieces(path)
        for batch in slices(batches, most=BYTES_AT_ONCE):
            keys = [row_key(i, seed) for i in batch.column("doc_id").to_pylist()]
            which, lp, value, inclusion, ids, bounds = sample_arrays(p, pc.fill_null(batch.column("text"), ""), keys, samples)
            number = np.arange(len(which)) - np.searchsorted(which, which) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(which)), pa.array(number.astype(np.int32)), pa.array(lp), pa.array(value), pa.array(inclusion),
                 pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32, copy=False)))],
                ["doc_id", "sample", "log_prob", "perturbed", "inclusion", "n_pieces", "ids"],
            )

    return doc_texts(docs).mapInArrow(run, SAMPLED)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids: the model's own best segmentation, by the sentencepiece library. Null or empty text: no ids."""
    path = model or default_model()

    def run(batches):
        library = pieces(path).model
        for batch in batches:
            found = library.encode([t or "" for t in batch.column("text").to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, text of rows with ids; null ids give the empty text."""
    ship(encoded.sparkSession)
    path = model or default_model()

    def run(batches):
        library = pieces(path).model
        for batch in batches:
            found = library.decode([list(x or []) for x in batch.column("ids").to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
