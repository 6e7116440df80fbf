"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Merges never cross a match of the splitting pattern, and matches repeat a lot: each is encoded by the library once and kept
in a bounded table per worker.  Texts of code points outside the settled ranges go through the library as a whole, and so
does every text if the definition does anything but split by ``PATTERN`` and merge bytes.

Defined results: null text counts as empty and gives no ids; strings of special tokens in a text are ordinary text,
unless ``added_tokens`` asks for what the library does by itself (each becomes its one id);
repeated rows are encoded each for itself; only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.support import kept, map_batches, parts, slices, text_of

#: Matches in a table's younger half (at most twice as many in all, of about 150 bytes), and the longest that are kept.
KEPT_MATCHES = 500_000
KEPT_LENGTH = 48
#: Characters handed to the library, and worked on, at a time.
BATCH_CHARACTERS = 1_500_000
#: Ids that are decoded to text at a time.
RUN = 4096

#: Code points whose letters, numbers and spaces have long been settled: Latin to Cyrillic, punctuation and symbols.
SETTLED = ((0, 0x530), (0x2010, 0x2BFF), (0x1F300, 0x1F650))
#: The pattern that ``settled_pattern`` spells out (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space among them (fixed value).
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u2028\u2029\u202f\u205f"


def character_class(kind: str) -> str:
    """Ranges, for a regular expression, of the settled code points of a general category."""
    points = [c for a, b in SETTLED for c in range(a, b) if unicodedata.category(chr(c))[0] == kind]
    starts = [c for c, before in zip(points, [-2, *points]) if c != before + 1]
    ends = [c for c, after in zip(points, [*points[1:], -2]) if c + 1 != after]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def settled_pattern() -> re.Pattern:
    """The splitting pattern (letters, numbers, other marks, white space) for texts of settled code points."""
    letters, numbers, spaces = character_class("L"), character_class("N"), SPACES
    runs = f" ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|{runs}|[{spaces}]+(?![^{spaces}])|[{spaces}]+")


def splits_as_expected(definition: dict) -> bool:
    """Whether the definition splits by ``PATTERN``, spells bytes and merges, and nothing else changes the ids."""
    model = definition["model"]
    others = [definition.get(x) for x in ("normalizer", "truncation", "padding")]
    others += [model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")]
    if any(others) or model.get("type", "BPE") != "BPE":
        return False
    steps = definition.get("pre_tokenizer") or {}
    *first, last = steps.get("pretokenizers") or [steps]
    if last.get("type") != "ByteLevel" or last.get("add_prefix_space", True):
        return False
    if last.get("use_regex", True):  # by the library's own copy of the pattern
        return not first
    split = {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Isolated", "invert": False}
    return first == [split]


UNSETTLED = re.compile("[^" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in SETTLED) + "]")


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: itself where printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The last merge that makes ``token``: join lower-ranked neighbours until two parts are left."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        joined = [ranks.get(a + b, len(ranks)) for a, b in zip(parts, parts[1:])]
        at = joined.index(min(joined))
        if joined[at] >= ranks[token]:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts) if len(parts) == 2 else None


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> str:
    """Tokenizer definition (JSON) that encodes by the ranks, each match of ``pattern`` for itself."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_characters()
    spelled = lambda token: "".join(table[b] for b in token)
    merges = [merge_of(token, ranks) for token in sorted(ranks, key=ranks.get) if len(token) > 1]
    made = Tokenizer(
        models.BPE(
            vocab={spelled(token): rank for token, rank in ranks.items()},
            merges=[(spelled(a), spelled(b)) for a, b in filter(None, merges)],
            ignore_merges=True,
        )
    )
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return made.to_str()


def token_bytes(definition: str) -> dict[int, bytes]:
    """The bytes of each id: the byte table read backwards; an added token stands for its own text."""
    back, parsed = {c: b for b, c in enumerate(byte_characters())}, json.loads(definition)
    vocabulary = parsed["model"]["vocab"]
    added = {t["id"]: t["content"].encode() for t in parsed.get("added_tokens") or ()}
    return added | {i: bytes(back[c] for c in word) for word, i in vocabulary.items() if all(c in back for c in word)}


class Recent(dict):
    """Bounded table: when the younger half is full it becomes the older one; what is found there is taken over.

    Looking up what is in neither gives None and notes it in ``wanted``.
    """

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older, self.wanted = most, {}, set()

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            self.wanted.add(key)
        else:
            self[key] = value
        return value

    def age(self) -> None:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()


class Encoder:
    """Whole texts to ids, as little-endian unsigned 32-bit integers.

    With ``added_tokens`` the definition's added tokens are taken out of a text first, as the library does by itself;
    without, special ones are ordinary text.  Texts that hold one go through the library as a whole.
    """

    def __init__(self, definition: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = not added_tokens
        parsed = json.loads(definition)
        self.by_matches = splits_as_expected(parsed)
        added = parsed.get("added_tokens") or ()
        self.added = [t["content"] for t in added if t["content"] and (added_tokens or not t["special"])]
        self.model = Tokenizer(self.tokenizer.model)  # without splitting: for single matches of the pattern
        self.spelling = "".join(byte_characters())
        self.pattern = settled_pattern()
        self.matches = Recent(KEPT_MATCHES)

    def _texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts by the library."""
        out = []
        for a, b in slices([len(t) for t in texts], BATCH_CHARACTERS):
            encoded = self.tokenizer.encode_batch_fast(texts[a:b], add_special_tokens=False)
            out += [np.array(e.ids, dtype="<u4").tobytes() for e in encoded]
        return out

    def _spelled(self, matches: list[str]) -> list[str]:
        """The strings that stand for the bytes of each match."""
        spelled = "\0".join(matches).encode().decode("latin-1").translate(self.spelling).split(self.spelling[0])
        if len(spelled) == len(matches):
            return spelled
        return [m.encode().decode("latin-1").translate(self.spelling) for m in matches]  # some hold a zero byte

    def _single_matches(self, matches: list[str]) -> list[bytes]:
        """Ids of strings that are one match of the pattern each, by the library's merges alone."""
        out = []
        for a in range(0, len(matches), 4096):
            spelled = self._spelled(matches[a : a + 4096])
            encoded = self.model.encode(spelled, is_pretokenized=True, add_special_tokens=False)
            packed = np.array(encoded.ids, dtype="<u4").tobytes()
            ends = (4 * np.cumsum(np.bincount(encoded.word_ids, minlength=len(spelled)))).tolist()
            out += [packed[start:end] for start, end in zip([0, *ends], ends)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids for a, b in slices([len(t) for t in texts], BATCH_CHARACTERS) for ids in self._encode(texts[a:b])]

    def _encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_matches:
            return self._texts(texts)
        self.matches.age()
        known, out, split, whole = self.matches, [b""] * len(texts), {}, []
        for i, text in enumerate(texts):
            if (not text.isascii() and UNSETTLED.search(text)) or any(t in text for t in self.added):
                whole.append(i)
                continue
            matches = self.pattern.findall(text)
            ids = list(map(known.__getitem__, matches))
            if None in ids:
                split[i] = matches, ids
            else:
                out[i] = b"".join(ids)
        wanted = list(known.wanted)
        known.wanted.clear()
        learnt = dict(zip(wanted, self._single_matches(wanted)))
        known.update((m, ids) for m, ids in learnt.items() if len(m) <= KEPT_LENGTH)
        for i, (matches, ids) in split.items():
            out[i] = b"".join([learnt[m] if x is None else x for m, x in zip(matches, ids)])
        for i, ids in zip(whole, self._texts([texts[i] for i in whole])):
            out[i] = ids
        return out


def encoder(definition: str, added_tokens: bool = False) -> Encoder:
    """This worker's encoder for a definition; kept, as workers serve many tasks."""
    name = ("encoder", hashlib.sha256(definition.encode()).digest(), added_tokens)
    return kept(name, lambda: Encoder(definition, added_tokens))


class Decoder:
    """Ids back to bytes and text."""

    def __init__(self, definition: str):
        self.table = token_bytes(definition)
        self.sizes = np.zeros(max(self.table, default=-1) + 1, dtype=np.int64)
        for i, content in self.table.items():
            self.sizes[i] = len(content)

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def decode_stream(self, ids, run: int = 1) -> Iterator[str]:
        """Text piece by piece, of ``run`` ids each; a character split over several ids comes with the id that completes it."""
        import codecs

        pending = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), run):
            yield pending.decode(self.decode_bytes(ids[at : at + run]))
        yield pending.decode(b"", final=True)

    def offsets(self, ids, content: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First and end character of each id in the decoded text (``content``); ids that split a character share it."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return ids, ids
        content = np.frombuffer(self.decode_bytes(ids.tolist()) if content is None else content, dtype=np.uint8)
        begins = (content & 0xC0) != 0x80  # bytes that begin a character
        sizes = self.sizes[ids]
        at = np.cumsum(sizes) - sizes
        ends = np.cumsum(np.add.reduceat(begins, at, dtype=np.int64))
        return np.r_[0, ends[:-1]] - ~begins[at], ends


def splits(starts: np.ndarray, ends: np.ndarray) -> int:
    """How many ids share a character with the id before or after."""
    shared = starts[1:] < ends[:-1]
    return int((np.r_[False, shared] | np.r_[shared, False]).sum()) if len(starts) else 0


def decoder(definition: str) -> Decoder:
    return kept(("decoder", hashlib.sha256(definition.encode()).digest()), lambda: Decoder(definition))


def encode(df: DataFrame, definition: str, key: str = "doc_id", text: str = "text", offsets: bool = False) -> DataFrame:
    """``key``, ``ids`` array<int>, and with ``offsets`` the first and end character of each id."""
    shared = df.sparkSession.sparkContext.broadcast(definition)  # the size of a vocabulary
    source = df.select(F.col(key).alias(key), text_of(df, text).alias("text"))
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>" + (
        ", starts array<int>, ends array<int>" if offsets else ""
    )

    def work(batches):
        made, back = encoder(shared.value), decoder(shared.value) if offsets else None
        for batch in batches:
            for part in parts(batch, 1):
                ids = [np.frombuffer(x, dtype="<u4").astype(np.int32) for x in made.encode(part.column(1).to_pylist())]
                columns = [part.column(0), pa.array(ids, pa.list_(pa.int32()))]
                if offsets:
                    spans = [back.offsets(x.tolist()) for x in ids]
                    columns += [pa.array([s[k].astype(np.int32) for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, [key, "ids", "starts", "ends"][: len(columns)])

    return map_batches(source, work, schema)


def decode(df: DataFrame, definition: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the decoded ``content`` as bytes; null ids count as none."""
    shared = df.sparkSession.sparkContext.broadcast(definition)
    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, content binary"

    def work(batches):
        back = decoder(shared.value)
        for batch in batches:
            content = [back.decode_bytes(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], [key, "content"])

    return map_batches(df.select(key, ids), work, schema)


def round_trip_digests(df: DataFrame, definition: str) -> DataFrame:
    """Encode every text, decode its ids, and return the digests of both in one pass (no shuffle).

    Further columns: characters of the text that the ids give run by run, ids that share a character with a neighbour, and the
    unsigned crc32 of all first and end characters (little-endian unsigned 32-bit integers, a pair for each id).
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)
    source = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(df).alias("text"))
    digests = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    digests |= {"n_characters": pa.int64(), "split_tokens": pa.int64(), "offsets_crc32": pa.int64()}

    def digest(packed: bytes, back: Decoder, decimal: dict[int, str]) -> tuple:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        content = back.decode_bytes(ids)
        starts, ends = back.offsets(ids, content)
        return (
            len(ids),
            hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
            hashlib.sha256(content).hexdigest(),
            sum(map(len, back.decode_stream(ids, RUN))),
            splits(starts, ends),
            zlib.crc32(np.column_stack([starts, ends]).astype("<u4").tobytes()),
        )

    def work(batches):
        made, back = encoder(shared.value), decoder(shared.value)
        decimal = {i: str(i) for i in back.table}
        for batch in batches:
            rows = [
                digest(packed, back, decimal) for part in parts(batch, 1) for packed in made.encode(part.column(1).to_pylist())
            ]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(digests.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *digests])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_characters long, split_tokens long"
    return map_batches(source, work, f"{schema}, offsets_crc32 long")
