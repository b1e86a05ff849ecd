"""SentencePiece encoding and decoding with the tokenizers library.

The model protobuf is parsed and its parts are rebuilt: the normaliser (its table of
character mappings, white-space rules, the metaspace marker), the unigram scores or the
merges that the scores of a BPE model imply, and the byte fallback. Parity with the
SentencePiece library is verified before anything is encoded.

Where no piece has the marker behind another character, no piece crosses the start of a
marked word, so a text is encoded and decoded word by word. A task remembers the words it
has met with their ids and what these decode to, in two tables of bounded size: when the
younger one is full it becomes the older one, from which words in use come back. Words that
are new in a batch are encoded, and their ids decoded, together, by several threads.

Defined results: a null text has null ids and decodes to null; an empty text has no ids
and decodes to an empty text. Repeated rows are encoded row by row. Other columns are kept;
the names of new columns are parameters.
"""

import hashlib
import os
import re
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
from tokenizers import Tokenizer, decoders, models, normalizers

from panelwright.llm.texts import add_columns

MARKER = "▁"
CACHED_WORDS = 250_000
CALL_WORDS = 10_000  # words in one call of the tokenizer, whose results are large
SLICE_BYTES = 2 << 20  # of text that a task codes at once
THREADS = 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # piece types of the format
UNIGRAM, BPE = 1, 2  # model types of the format
_WORDS = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
PROBES = (
    "", " ", "  ", "a", " a", "a ", "The quick  brown fox.", "\n", "a\n\nb", "tab\there", "Straße, élève, niño",
    "日本語 中文", "🙂 👩‍👩‍👧", " x y", "zero​width", "123 456,789.00", "x" * 300, "ﬁ Å ①", "▁ marker",
    "<unk> <s> </s> <0x0A>", "\x00\x01\x7f", "é",
)


class Model:
    """A parsed model: its tokenizer, and what the word-by-word path needs to know."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        trainer, spec = proto.trainer_spec, proto.normalizer_spec
        if trainer.treat_whitespace_as_suffix:
            raise ValueError("models that mark the end of a word are not supported")
        pieces = list(proto.pieces)
        if any(p.type == USER for p in pieces):
            raise ValueError("models with user-defined pieces are not supported")
        if trainer.model_type == UNIGRAM:
            core = models.Unigram([(p.piece, p.score) for p in pieces], trainer.unk_id, trainer.byte_fallback)
        elif trainer.model_type == BPE:
            core = _bpe(pieces, trainer)
        else:
            raise ValueError(f"model type {trainer.model_type} is neither unigram nor BPE")
        self.tokenizer = Tokenizer(core)
        self.dummy_prefix = spec.add_dummy_prefix
        steps = []
        if spec.precompiled_charsmap:
            steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
        if spec.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(_pattern(" {2,}"), " ")]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        self.tokenizer.decoder = decoders.Sequence([
            decoders.Replace(MARKER, " "), decoders.ByteFallback(), decoders.Fuse(),
        ])
        usable = [p.piece for p in pieces if p.type == NORMAL]
        self.by_word = not any(MARKER in p.lstrip(MARKER) for p in usable)
        self.starts = np.array([p.type == NORMAL and p.piece.startswith(MARKER) for p in pieces])
        self.ids: dict[str, bytes] = {}  # of words, by ``_key``
        self.texts: dict[str, str] = {}  # what these ids decode to
        self.older: tuple[dict[str, bytes], dict[str, str]] = {}, {}
        self.decoded: dict[bytes, str] = {}

    def prepared(self, text: str) -> str:
        """The text as the model's normaliser leaves it, with markers for spaces."""
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        text = text.replace(" ", MARKER)
        return MARKER + text if text and self.dummy_prefix else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as 32-bit numbers."""
        return self.coded(texts)[0]

    def coded(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids of each text, as 32-bit numbers, and the text that decoding them gives."""
        prepared = [self.prepared(t) for t in texts]
        if not self.by_word:
            ids = [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(prepared, add_special_tokens=False)]
            return ids, self.decode(ids)
        keys = [_keys(t) for t in prepared]
        if len(self.ids) > CACHED_WORDS:
            self.older, self.ids, self.texts = (self.ids, self.texts), {}, {}
        ids, decoded = self.ids, self.texts
        new = set(chain.from_iterable(keys)).difference(ids)
        back = new.intersection(self.older[0])
        ids.update((k, self.older[0][k]) for k in back)
        decoded.update((k, self.older[1][k]) for k in back)
        new = list(new - back)
        for at in range(0, len(new), CALL_WORDS):
            call = new[at: at + CALL_WORDS]
            words = [k[1:] if k.startswith(MARKER) else MARKER + k for k in call]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            ids.update(zip(call, map(_packed, found)))
            decoded.update(zip(call, self.tokenizer.decode_batch(found, skip_special_tokens=False)))
        packed = [b"".join(map(ids.__getitem__, ks)) for ks in keys]
        return packed, [self._unprefixed("".join(map(decoded.__getitem__, ks))) for ks in keys]

    def _unprefixed(self, text: str) -> str:
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def decode(self, ids: list[bytes]) -> list[str]:
        """The texts of packed ids."""
        parts = [self._words_of(i) for i in ids] if self.by_word else [[i] for i in ids]
        known = self.decoded
        if len(known) > CACHED_WORDS:
            known.clear()
        new = list(set(chain.from_iterable(parts)).difference(known))
        for at in range(0, len(new), CALL_WORDS):
            call = new[at: at + CALL_WORDS]
            lists = [array("i", p).tolist() for p in call]
            known.update(zip(call, self.tokenizer.decode_batch(lists, skip_special_tokens=False)))
        return [self._unprefixed("".join(map(known.__getitem__, ps))) for ps in parts]

    def _words_of(self, ids: bytes) -> list[bytes]:
        """The ids cut before each piece that starts a marked word."""
        numbers = np.frombuffer(ids, dtype="i4")
        if not len(numbers):
            return []
        cuts = np.flatnonzero(self.starts[numbers]) * 4
        ends = [*cuts[1:].tolist(), len(ids)] if len(cuts) else [len(ids)]
        firsts = cuts.tolist() if len(cuts) else [0]
        head = [ids[: firsts[0]]] if firsts[0] else []
        return head + [ids[a:b] for a, b in zip(firsts, ends)]


def _keys(text: str) -> list[str]:
    """The words of a prepared text; a marker in front is left out of a word that has just one.

    A word that has none or several gets one more instead, so that no two words share a key.
    """
    words = text.split(MARKER)
    if not words[0] and "" not in words[1:]:
        return words[1:]
    return [
        w[1:] if w.startswith(MARKER) and w[1:2] not in ("", MARKER) else MARKER + w for w in _WORDS.findall(text)
    ]


def _pattern(regex: str):
    from tokenizers import Regex

    return Regex(regex)


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def _bpe(pieces, trainer) -> models.BPE:
    """A BPE model whose merges are the splits of each piece into two, the best score first."""
    ids = {p.piece: i for i, p in enumerate(pieces)}
    merges = []
    for piece in pieces:
        if piece.type == NORMAL:
            text = piece.piece
            merges += [
                (-piece.score, ids[text[:at]], ids[text[at:]], text[:at], text[at:])
                for at in range(1, len(text)) if text[:at] in ids and text[at:] in ids
            ]
    return models.BPE(
        vocab=ids, merges=[m[3:] for m in sorted(merges)], unk_token=pieces[trainer.unk_id].piece,
        fuse_unk=True, byte_fallback=trainer.byte_fallback,
    )


@lru_cache(maxsize=2)
def _model(digest: str, model: bytes) -> Model:
    return Model(model)


def disparities(model: bytes, texts) -> list[str]:
    """The texts that the rebuilt tokenizer and the SentencePiece library encode or decode differently."""
    rebuilt, original = Model(model), SentencePieceProcessor(model_proto=model)
    found = []
    for text in texts:
        ids = original.encode(text)
        packed = rebuilt.encode([text])[0]
        if packed != _packed(ids) or (rebuilt.decode([packed])[0] != original.decode(ids) and MARKER not in text):
            found.append(text)
    return found


def encoded(
    df: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids", same_col: str = "round_trip",
    threads: int = THREADS,
) -> DataFrame:
    """All columns, the ids of the text, and whether decoding them gives the text as it was.

    ``model`` is the content of a model file. A text whose characters the normaliser
    changes, or that holds the marker itself, does not come back as it was.
    """
    wrong = disparities(model, PROBES)
    if wrong:
        raise ValueError(f"the rebuilt tokenizer differs from the SentencePiece library on {wrong[:3]!r}")
    digest = hashlib.sha256(model).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast(model)  # a vocabulary: its size does not follow the data

    def start():
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        rebuilt = _model(digest, sent.value)

        def step(texts):
            given = [t.decode(errors="replace") for t in texts if t is not None]
            ids, back = rebuilt.coded(given)
            same = iter([a == b for a, b in zip(back, given)])
            ids = iter(ids)
            return [
                [None if t is None else np.frombuffer(next(ids), dtype="i4") for t in texts],
                [None if t is None else next(same) for t in texts],
            ]

        return step

    return add_columns(df, text_col, start, f"`{ids_col}` array<int>, `{same_col}` boolean", SLICE_BYTES)


def decoded(df: DataFrame, model: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns and the text of the ids."""
    digest = hashlib.sha256(model).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast(model)

    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def texts(ids):
        rebuilt = _model(digest, sent.value)
        packed = [None if i is None else _packed(i) for i in ids]
        found = iter(rebuilt.decode([p for p in packed if p is not None]))
        return ids.__class__([None if p is None else next(found) for p in packed], dtype=object)

    return df.withColumn(out_col, texts(ids_col))
