"""SentencePiece encoding and decoding by the tokenizers library.

The model's protobuf is parsed here; its normaliser, white-space marker, scores and byte fallback are rebuilt as a
tokenizers pipeline (Unigram scores as they are, BPE scores as the order of merges), which encodes batches on several
threads. The sentencepiece library is only the reference that parity is verified against.
"""

from __future__ import annotations

import functools
import itertools
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import lean, share_of

MARK = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = data[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + n]
        at += n


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    suffix_mark: bool = False

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                x = dict(_fields(value))
                out.pieces.append((x[1].decode(), struct.unpack("<f", x.get(2, bytes(4)))[0], x.get(3, NORMAL)))
            elif number == 2:
                x = dict(_fields(value))
                out.kind, out.byte_fallback, out.suffix_mark = x.get(3, UNIGRAM), bool(x.get(35, 0)), bool(x.get(24, 0))
            elif number == 3:
                x = dict(_fields(value))
                out.charsmap, out.dummy_prefix, out.squeeze, out.escape = x.get(2, b""), bool(x.get(3, 1)), bool(x.get(4, 1)), bool(x.get(5, 1))
        if out.kind not in (UNIGRAM, BPE) or out.suffix_mark:
            raise ValueError("only Unigram and BPE models with a leading white-space mark are supported")
        return out

    def tokenizer(self):
        """The same model as a tokenizers pipeline."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        ids = {p: i for i, (p, _, _) in enumerate(self.pieces)}
        unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN), None)
        if self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=unknown, byte_fallback=self.byte_fallback)
        else:
            usable = {p for p, _, t in self.pieces if t in (NORMAL, USER)}
            merges = []
            for p, score, t in self.pieces:
                if t == NORMAL:
                    merges += [(-score, ids[p], ids[p[:k]], p[:k], p[k:]) for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
            model = models.BPE(ids, [(a, b) for *_, a, b in sorted(merges)], unk_token=self.pieces[unknown][0] if unknown is not None else None, fuse_unk=True, byte_fallback=self.byte_fallback)
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        normal = [p for p, _, t in self.pieces if t == NORMAL]
        if self.kind == BPE and not any("\n" in p for p in normal):
            # No merge goes over a line's end, and whole lines cost less than their words one by one.
            out.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
        elif not any(MARK in p.lstrip(MARK) for p in normal):
            # No piece goes on behind a mark that follows other characters, so texts part there, and words can be cached.
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        out.add_tokens([AddedToken(p, normalized=False) for p, _, t in self.pieces if t == USER])
        strip = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        out.decoder = decoders.Sequence([decoders.Metaspace(MARK, "never"), decoders.ByteFallback(), decoders.Fuse(), *strip])
        return out

    def plain(self, text: str, tokenizer) -> str:
        """What decoding an encoded text gives: the text as the normaliser leaves it."""
        if self.charsmap:
            text = tokenizer.normalizer.normalize_str(text).replace(MARK, " ")
            return text[1:] if self.dummy_prefix and text[:1] == " " else text
        text = text.replace(MARK, " ")
        if self.squeeze:
            text = " ".join(x for x in text.split(" ") if x)
        return text


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes, threads: int):
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    model = Model.parse(data)
    return model, model.tokenizer()


def _lists(ids: list[list[int]]) -> pa.Array:
    """Lists of ids as an Arrow array, by way of flat numbers."""
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(itertools.chain.from_iterable(ids), np.int32, ends[-1])))


def _parts(column: pa.Array, most: int = 1 << 18) -> Iterator[pa.Array]:
    """Runs of texts of about 256 KB, so that what is encoded at once is bounded."""
    at = n = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        n += length
        if n >= most or i - at >= 1023:
            yield column.slice(at, i + 1 - at)
            at, n = i + 1, 0
    if at < len(column):
        yield column.slice(at)


def encode(docs: DataFrame, model_path: str, threads: int = 2, verify: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_tokens, ids (array of int), round_trip (the library's decoding gives the normalised text again).

    Null texts encode like empty ones, to no ids. Repeated rows are kept, an empty table gives no rows, other columns are
    ignored. verify: the share of keys, chosen by a hash, whose ids are held against the sentencepiece library's, all of them unless
    a caller asks for less; any difference fails the job. The model file is read on the driver and sent along.
    """
    with open(model_path, "rb") as f:
        data = f.read()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokenizer = _loaded(data, threads)
        import sentencepiece

        other = sentencepiece.SentencePieceProcessor(model_proto=data)
        for batch in batches:
            at = 0
            for texts in _parts(batch.column(1)):
                part = [x or "" for x in texts.to_pylist()]
                ids = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                checked = [i for i, x in enumerate(batch.column(2).slice(at, len(part)).to_pylist()) if x]
                for i, got in zip(checked, other.encode([part[i] for i in checked], num_threads=1), strict=True):
                    if got != ids[i]:
                        raise ValueError(f"{batch.column(0)[at + i]}: {len(got)} ids by sentencepiece, {len(ids[i])} here, or others")
                back = tokenizer.decode_batch(ids, skip_special_tokens=False)
                same = [a == model.plain(b, tokenizer) for a, b in zip(back, part, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array([len(x) for x in ids], pa.int32()), _lists(ids), pa.array(same, pa.bool_())], [key, "n_tokens", "ids", "round_trip"])
                at += len(part)

    kind = docs.schema[key].dataType.simpleString()
    return lean(docs).select(key, text, share_of(F.col(key), verify, 17).alias("checked")).mapInArrow(encoded, f"`{key}` {kind}, n_tokens int, ids array<int>, round_trip boolean")


def decode(rows: DataFrame, model_path: str, threads: int = 2, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key, text. Null ids give a null, no ids an empty text."""
    with open(model_path, "rb") as f:
        data = f.read()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, tokenizer = _loaded(data, threads)
        for batch in batches:
            got = batch.column(1).to_pylist()
            texts = tokenizer.decode_batch([x or [] for x in got], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else t for x, t in zip(got, texts, strict=True)], pa.string())], [key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return lean(rows).select(key, ids).mapInArrow(decoded, f"`{key}` {kind}, text string")
