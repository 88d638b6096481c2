"""Byte-level BPE on a sentencepiece model that is serialised directly from a rank vocabulary.

Each vocabulary entry becomes a piece spelled with one printable character per byte; its score is the negative rank, so
sentencepiece's highest-score-first merging is lowest-rank-first merging. Normalisation is the identity. Texts are cut
into pre-tokens by the tokenizer's pattern, each encoded alone; decoding is the inverse mapping from id to bytes.

Defined results: a null text is an empty one (no ids); repeated rows are encoded each; a null id stays null; columns
other than the named two are not read, so extra or clashing ones do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from siftline.llm.common import map_batches, own_memory, texts_of

#: Entries of a worker's memo of encoded parts (about 60 MB); a full one stays as the older of two. Results do not depend on it.
MEMO = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where printable in Latin-1, else the next free one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def serialize_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model: piece id = rank, score = -rank, identity normaliser, an unknown piece after the last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    by_rank = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in by_rank] != list(range(len(by_rank))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be 0..n-1 and hold every single byte")
    letters = byte_letters()
    model = pb.ModelProto()
    for rank, token in enumerate(by_rank):
        model.pieces.add(piece="".join(letters[b] for b in token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=-float(len(by_rank)), type=pb.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type, spec.vocab_size, spec.unk_id = pb.TrainerSpec.BPE, len(model.pieces), len(by_rank)
    spec.bos_id = spec.eos_id = spec.pad_id = -1
    norm = model.normalizer_spec
    norm.name, norm.precompiled_charsmap = "identity", b""
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder in one process. `pattern` cuts texts into pre-tokens."""

    def __init__(self, model: bytes, pattern: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(pattern).findall
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        back = {ord(letter): b for b, letter in self.letters.items()}
        self.token_bytes = {str(i): bytes(back[ord(c)] for c in self.sp.id_to_piece(i)) for i in range(self.sp.get_piece_size() - 1)}
        self.decimal = list(map(str, range(self.sp.get_piece_size())))
        # What follows a space (memo) or begins a text (first), as ids in decimal. A single space between two non-space
        # characters always starts a pre-token; so texts can be cut there, and each distinct part is encoded once.
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.cut = regex.compile(r"(?<=\S) (?=\S)", regex.V0).split

    def encode_parts(self, parts: list[str]) -> list[str]:
        """Context-free parts of texts: pre-tokens by the pattern, each encoded alone."""
        pre = list(map(self.find, parts))
        flat = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) for ps in pre for p in ps]
        ids, decimal = iter(self.sp.encode(flat, num_threads=1)), self.decimal.__getitem__
        return [" ".join([" ".join(map(decimal, next(ids))) for _ in ps]) for ps in pre]

    def encode_all(self, texts: list[str]) -> list[str]:
        """The ids of each text, in decimal, joined by a space."""
        cut = [t.split(" ") for t in texts]
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        new = set().union(*(c[1:] for c in cut)).difference(memo)
        # A part with white space at an end is not context-free: texts that have one are cut with more care.
        loose = {p for p in new if not p or p[0].isspace() or p[-1].isspace()}
        ends: dict[int, str] = {}
        for i, parts in enumerate(cut):
            if (parts[0] == "" or parts[0][-1].isspace()) or not loose.isdisjoint(parts):
                cut[i] = self.cut(texts[i])
                if len(cut[i]) > 1 and cut[i][-1][-1].isspace():  # right at the end of a text only, so it is not kept
                    ends[i] = self.encode_parts([" " + cut[i].pop()])[0]
                loose.difference_update(cut[i][1:])  # no white space to the pattern after all
                new.update(cut[i][1:])
        memo.update({p: older[p] for p in new & older.keys()})
        new = list(new.difference(memo, loose))
        for at in range(0, len(new), 20_000):
            some = new[at : at + 20_000]
            memo.update(zip(some, self.encode_parts([" " + p for p in some]), strict=True))
        firsts = self.encode_parts([c[0] for c in cut])
        out = [" ".join([first, *map(memo.__getitem__, c[1:])]) if len(c) > 1 else first for first, c in zip(firsts, cut, strict=True)]
        for i, end in ends.items():
            out[i] = f"{out[i]} {end}"
        return out

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.split(" "))) if ids else b""


_codecs: dict[str, Codec] = {}


def codec(model: bytes, pattern: str) -> Codec:
    """One codec a worker process and model, kept between tasks."""
    key = hashlib.sha1(model + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, pattern)
        own_memory(__name__, _codecs.clear)
    return _codecs[key]


def encode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, ids array<int>: every whole text encoded."""
    spark = df.sparkSession
    model = spark.sparkContext.broadcast(serialize_model(read_ranks(vocabulary)))
    name = id_col

    def make():
        c = codec(model.value, pattern)

        def each(batch):
            ids = [list(map(int, s.split(" "))) if s else [] for s in c.encode_all(texts_of(batch))]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [name, "ids"])

        return each

    rows = df.select(df[id_col].alias(name), df[text_col].alias("text"))
    return map_batches(rows, make, f"{name} {dict(rows.dtypes)[name]}, ids array<int>")


def decode(df: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, bytes binary: the inverse of `encode`; null ids decode to no bytes."""
    model = df.sparkSession.sparkContext.broadcast(serialize_model(read_ranks(vocabulary)))
    name = id_col

    def make():
        c = codec(model.value, pattern)

        def each(batch):
            out = [c.decode(" ".join(map(str, ids or []))) for ids in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [name, "bytes"])

        return each

    rows = df.select(df[id_col].alias(name), df[ids_col].alias("ids"))
    return map_batches(rows, make, f"{name} {dict(rows.dtypes)[name]}, bytes binary")


def round_trip_digests(df: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Per document: n_tokens, SHA-256 of the ids in decimal joined by one space, SHA-256 of the decoded bytes."""
    model = df.sparkSession.sparkContext.broadcast(serialize_model(read_ranks(vocabulary)))

    def make():
        c = codec(model.value, pattern)

        def each(batch):
            n, ids_sha, bytes_sha = [], [], []
            rows = batch.column(1)
            for at in range(0, len(rows), 256):
                for ids in c.encode_all([t or "" for t in rows.slice(at, 256).to_pylist()]):
                    n.append(ids.count(" ") + 1 if ids else 0)
                    ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                    bytes_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(bytes_sha)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return each

    return map_batches(df.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
