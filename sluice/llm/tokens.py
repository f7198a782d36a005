"""Byte-level BPE encoding in Python tasks, by the tokenizers library, over whole Arrow batches.

A text is cut at spaces and before line ends. The vocabulary's own split pattern always starts a new piece there, so the
ids of a text are the ids of its chunks in order. Most chunks are at most a line end, a word and a mark, three pieces of
the pattern. Arrow cuts the texts of a batch and numbers their distinct chunks and words; each distinct word is looked
up or encoded once by the library's BPE model, and one take lays the ids out in the order of the texts. Other chunks are
cut by the pattern; texts with longer runs of white space or with added tokens go through the library's steps one by one.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from .common import worker_cache

#: Fixed value: the split pattern of the byte-level vocabulary.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries per generation: a full cache becomes the older generation, from which entries come back on use.
PIECES_KEPT = 150_000
#: Longer pieces are not kept, so that the cache stays small in bytes too.
LONGEST_KEPT = 64
#: A chunk of at most a line end, a word of Latin letters or digits, and marks, for Arrow's regular expressions.
_WORD = r"(?:[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+|[0-9]+)?"
SIMPLE = rf"^(?P<line>\n?)(?P<word>{_WORD})(?P<marks>[!-&(-/:-@\[-`{{-~]*)$"
#: White space other than space and line end, and runs of white space that are cut otherwise than before each.
_OTHER = r"[\t\r\x{0B}\x{0C}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
RUNS = rf" [ \n]|\n |\n\n\n|\n\n$|[ \n]{_OTHER}|{_OTHER}[ \n]"


class Generations:
    """A bounded dictionary in two generations; make gives the values of many missing keys."""

    def __init__(self, kept: int, make: Callable[[list[str]], list[bytes]]):
        self.kept, self.make, self.new, self.old = kept, make, {}, {}

    def look_up(self, keys: list[str]) -> list[bytes]:
        found = list(map(self.new.get, keys))
        gone = [k for k, v in enumerate(found) if v is None]
        for k in gone:
            found[k] = self.old.get(keys[k])
        made = [k for k in gone if found[k] is None]
        for k, value in zip(made, self.make([keys[k] for k in made])):
            found[k] = value
        if len(self.new) + len(gone) > self.kept:
            self.old, self.new = self.new, {}
        self.new.update((keys[k], found[k]) for k in gone if len(keys[k]) <= LONGEST_KEPT)
        return found


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else the next one from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}


class ByteBpe:
    """Ids of texts; added tokens in a text are their own ids."""

    def __init__(self, path: str):
        library = Tokenizer.from_file(path)
        self.model = library.model
        added = library.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that strip spaces or need word ends are not handled")
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        self.around_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split
        self.odd = "|".join([RUNS, *map(re.escape, self.added)])
        self.split = regex.compile(SPLIT_PATTERN).findall
        self.alphabet = byte_alphabet()
        self.cache = Generations(PIECES_KEPT, self.encode_pieces)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of the split pattern, each as little-endian unsigned 32-bit bytes."""
        tokenize = self.model.tokenize
        spelled = "\0".join(pieces).encode("utf-8", "replace").decode("latin-1").translate(self.alphabet).split(self.alphabet[0])
        if len(spelled) != len(pieces):  # a piece holds the separator itself
            spelled = [x.encode("utf-8", "replace").decode("latin-1").translate(self.alphabet) for x in pieces]
        return [array("I", [token.id for token in tokenize(x)]).tobytes() for x in spelled] if pieces else []

    def pieces(self, text: str) -> bytes:
        return b"".join(self.cache.look_up(self.split(text)))

    def encode(self, text: str) -> bytes:
        """Ids of any text, one by one."""
        return b"".join(self.added.get(part) or self.pieces(part) for part in self.around_added(text) if part)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text) of texts without added tokens and runs of white space."""
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        first = cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        flat = cut.flatten()
        numbered = flat.dictionary_encode()
        chunks = numbered.dictionary
        parts = pc.extract_regex(chunks, SIMPLE)
        others = np.flatnonzero(parts.is_null().to_numpy(zero_copy_only=False))
        line, word, marks = (pc.fill_null(pc.struct_field(parts, name), "") for name in ("line", "word", "marks"))
        # without a word or a line end before them, marks take the space; a space alone stands at a text's end
        unled, bare = pc.equal(line, ""), pc.and_(pc.equal(line, ""), pc.equal(word, ""))
        head = pc.if_else(unled, pc.binary_join_element_wise(" ", pc.if_else(bare, marks, word), ""), word)
        entries, encoded = np.zeros((len(chunks), 3), np.int64), [b""]
        for k, piece in enumerate((line, head, pc.if_else(bare, "", marks))):
            column = piece.dictionary_encode()
            entries[:, k] = column.indices.to_numpy().astype(np.int64) + len(encoded)
            encoded += self.cache.look_up(column.dictionary.to_pylist())
        entries[others] = 0
        entries[others, 1] = np.arange(len(encoded), len(encoded) + len(others))
        encoded += [self.pieces(c if c.startswith("\n") else " " + c) for c in chunks.take(pa.array(others)).to_pylist()]
        which = entries[numbered.indices.to_numpy()]
        which[first] = 0
        which[first, 1] = np.arange(len(encoded), len(encoded) + len(first))  # no space before it
        encoded += map(self.pieces, flat.take(pa.array(first)).to_pylist())
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        store = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(np.frombuffer(b"".join(encoded), "<i4"))
        )
        used = which.ravel()
        ids = store.take(pa.array(used[sizes[used] > 0])).flatten().to_numpy()
        return ids, np.add.reduceat(sizes[which].sum(axis=1), first) if len(first) else np.zeros(0, np.int64)

    def encode_texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each text followed by end_id, as int32; ids per text with the end)."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd)
        ids, sizes = self.words(texts.take(pa.array(plain)))
        total = np.zeros(len(texts), np.int64)
        total[plain] = sizes
        apart = {int(k): np.frombuffer(self.encode(texts[int(k)].as_py()), "<i4") for k in np.flatnonzero(odd)}
        for k, own in apart.items():
            total[k] = len(own)
        total += 1
        ends = np.cumsum(total)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        free = np.ones(len(out), bool)
        free[ends - 1] = False
        out[ends - 1] = end_id
        for k, own in apart.items():
            at = ends[k] - total[k]
            out[at : at + len(own)] = own
            free[at : at + len(own)] = False
        out[free] = ids
        return out, total


def byte_bpe(path: str) -> ByteBpe:
    """One encoder per worker process and vocabulary file."""
    return worker_cache(f"tokens {path}", lambda: ByteBpe(path))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
