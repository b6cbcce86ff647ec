"""Byte-level BPE through a sentencepiece model made from the ranks.

The model is written directly: one piece per token, each byte as one character, scored by the
negative rank, with identity normalisation and no space handling. Its merges are then those of
the ranks. Pre-tokens are encoded one by one (and remembered); ids are decoded by the inverse
byte mapping. A piece's id is its rank.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_worker, pick, tiktoken_ranks
from .pretokens import Cache, pretokens

#: A byte's character is this far above the byte: letters without any special role.
SHIFT = 0x100
CACHE_SIZE = 400_000


def mapped(data: bytes) -> str:
    return data.decode("latin-1").translate({b: b + SHIFT for b in set(data)})


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model. The unknown piece comes last; no text can reach it."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        model.pieces.add(piece=mapped(token), score=-float(rank), type=1)
    model.pieces.add(piece="<unk>", score=0.0, type=2)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(ranks)
    for name in ("bos_id", "eos_id", "pad_id"):
        setattr(model.trainer_spec, name, -1)
    model.normalizer_spec.name = "identity"
    for name in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
        setattr(model.normalizer_spec, name, False)
    return model.SerializeToString()


class Codec:
    def __init__(self, ranks: dict[bytes, int], cache_size: int = CACHE_SIZE):
        import sentencepiece

        if sorted(ranks.values()) != list(range(len(ranks))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        letters = {b: b + SHIFT for b in range(256)}
        # Decoding goes by the model's own pieces, back through the byte mapping.
        self.token = [bytes(ord(c) - SHIFT for c in model.id_to_piece(i))
                      for i in range(len(ranks))]
        self.number = [str(i) for i in range(len(ranks))]
        self.ids = Cache(lambda piece: tuple(model.encode(
            piece.encode().decode("latin-1").translate(letters))), cache_size)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        ids = self.ids
        for piece in pretokens(text):
            out += ids[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def codec(path: str) -> Codec:
    return per_worker(("codec", path), lambda: Codec(tiktoken_ranks(path)))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of every whole text by the ranks in ``path``. A null text counts
    as empty (no ids); each row has its own result, whatever its id."""
    def run(batches):
        coder = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([coder.encode(t) for t in batch.column(1).to_pylist()],
                                           pa.list_(pa.int32()))], names=["doc_id", "ids"])

    rows = pick(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, data (bytes) of each row's ids; null ids give null."""
    def run(batches):
        coder = codec(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if i is None else coder.decode(i)
                                            for i in batch.column(1).to_pylist()], pa.binary())],
                names=["doc_id", "data"])

    rows = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: ``encode``, then ``decode`` of its ids, in one
    pass that keeps only the digests. Null texts count as empty."""
    def run(batches):
        coder = codec(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            counts, digests, decoded = [], [], []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text)
                counts.append(len(ids))
                digests.append(sha(",".join(map(coder.number.__getitem__, ids)).encode()))
                decoded.append(sha(coder.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = pick(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
