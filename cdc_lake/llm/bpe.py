"""BPE encoding and decoding by tree concatenation (operator 1).

Documents up to ``piece_chars`` are encoded whole, where they lie.  A longer document is cut before white space that
follows a non-space, where the tokenizer's own splitting always cuts (it never looks back), so such pieces are
encoded independently, in parallel tasks, and their tokens concatenated.  Text without such a place is pre-split by
the tokenizer itself; a pre-token that is still longer than ``run_chars`` is halved until it is not, its leaves are
encoded in parallel, and the leaves are joined pairwise up the tree: at each join a window of tokens around the
border is re-encoded, and grown until its first and last token equal those already there.  Then the joined tokens
are the exact encoding: a token sequence is the encoding of its text if every two neighbours are the encoding of
theirs, and every neighbouring pair lies inside a side or inside the window.

The vocabulary file is a parameter, read on the driver and sent to the tasks (a fixed file of a few MB).  Ordinary
text runs through ``tiktoken`` with ranks taken from that file, which the tests hold equal to ``tokenizers`` on every
code point; a file whose ids are not its merge ranks is encoded by ``tokenizers`` itself.

Cases: null text is empty and has no tokens; every row is encoded, also repeated ones; a special token's string in a
text becomes the special token, as in ``tokenizers``.  A document's tokens are held in one task, as its text is.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

PIECE_CHARS = 16_384
RUN_CHARS = 4_096
SLICE = 256
#: Splitting pattern of byte-level BPE (fixed value of the tokenizer).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SAFE_CUT = re.compile(r"(?<=\S)(?=\s)")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(source)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(source)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = byte_letters()
        of = {c: b for b, c in enumerate(self.letters)}
        self.letters_of = {i: k for k, i in vocab.items()}
        ranks = {bytes(of[c] for c in k): i for k, i in vocab.items() if k not in self.special}
        self.bytes_of = {i: k for k, i in ranks.items()} | {i: k.encode() for k, i in self.special.items()}
        joined = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges)
        self.fast = None
        if all(vocab[k] == 256 + i for i, k in enumerate(joined)):
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            return self.fast.encode(text, allowed_special="all")
        return self.tok.encode(text, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    # -- long unsplit text -------------------------------------------------------------------------------------

    def pretokens(self, text: str) -> list[str | int]:
        """Pre-tokens in the vocabulary's letters; a special token as its id."""
        out: list[str | int] = []
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [w for w, _ in self.tok.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def merge(self, letters: str) -> list[int]:
        """Tokens of one pre-token, or of a piece of one."""
        return [t.id for t in self.tok.model.tokenize(letters)]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Exact tokens of two adjacent pieces of one pre-token, from the exact tokens of each."""
        k = 2
        while left and right:
            a, b = min(k, len(left)), min(k, len(right))
            new = self.merge("".join(self.letters_of[i] for i in (*left[-a:], *right[:b])))
            if (a == len(left) or new[0] == left[-a]) and (b == len(right) or new[-1] == right[b - 1]):
                return left[:-a] + new + right[b:]
            k *= 2
        return left or right

    def tree(self, leaves: list[list[int]]) -> list[int]:
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i]
                      for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []


@lru_cache(maxsize=1)
def codec(source: str) -> Codec:
    return Codec(source)


def halves(letters: str, limit: int) -> list[str]:
    """Recursive halves of a pre-token, each at most ``limit`` long."""
    if len(letters) <= limit:
        return [letters]
    mid = len(letters) // 2
    return halves(letters[:mid], limit) + halves(letters[mid:], limit)


def cut(text: str, c: Codec, piece_chars: int, run_chars: int) -> Iterator[tuple[int, list[str]]]:
    """Pieces of a long text: (run, parts).

    Run 0: one part, ordinary text.  Run -1: parts are whole pre-tokens.  Run n > 0: the part is a leaf of the n-th
    long pre-token.
    """
    at, run = 0, 0
    while at < len(text):
        m = SAFE_CUT.search(text, at + piece_chars // 2)
        end = m.start() if m else len(text)
        piece = text[at:end]
        at = end
        if len(piece) <= piece_chars:
            yield 0, [piece]
            continue
        small: list[str] = []
        for p in c.pretokens(piece):
            if isinstance(p, str) and len(p) > run_chars:
                if small:
                    yield -1, small
                    small = []
                run += 1
                for leaf in halves(p, run_chars):
                    yield run, [leaf]
            else:
                small.append(p if isinstance(p, str) else f"\0{p}")  # \0 is no letter of a byte-level vocabulary
                if len(small) >= run_chars:
                    yield -1, small
                    small = []
        if small:
            yield -1, small


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           piece_chars: int = PIECE_CHARS, run_chars: int = RUN_CHARS) -> DataFrame:
    """Every row's doc_id, ids (array of int) and decoded text."""
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), C.text_of(text_col).alias("text"))
    key = rows.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {key}, ids array<int>, decoded string"
    long_ = F.char_length("text") > piece_chars

    def whole(batches):
        c = codec(source.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = [c.encode(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(c.decode, ids), pa.string())],
                    ["doc_id", "ids", "decoded"])

    def pieces(batches):
        c = codec(source.value)
        for batch in batches:
            for i, rid, text in zip(batch.column(0), *(batch.column(k).to_pylist() for k in (1, 2))):
                got = list(cut(text, c, piece_chars, run_chars))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()] * len(got), batch.schema.field(0).type), pa.array([rid] * len(got), pa.int64()),
                     pa.array(range(len(got)), pa.int32()), pa.array([r for r, _ in got], pa.int32()),
                     pa.array([p for _, p in got], pa.list_(pa.string()))], ["doc_id", "rid", "seq", "run", "parts"])

    def leaves(batches):
        c = codec(source.value)

        def tokens(run, parts):
            if run == 0:
                return c.encode(parts[0])
            return [t for p in parts for t in ([int(p[1:])] if p[:1] == "\0" else c.merge(p))]

        for batch in batches:
            ids = [tokens(r, p) for r, p in zip(batch.column("run").to_pylist(), batch.column("parts").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in ("doc_id", "rid", "seq", "run")), pa.array(ids, pa.list_(pa.int32()))],
                ["doc_id", "rid", "seq", "run", "ids"])

    def gather(table: pa.Table) -> pa.Table:
        c = codec(source.value)
        rows_ = sorted(zip(*(table.column(k).to_pylist() for k in ("seq", "run", "ids"))))
        ids: list[int] = []
        i = 0
        while i < len(rows_):
            run, j = rows_[i][1], i + 1
            while run > 0 and j < len(rows_) and rows_[j][1] == run:
                j += 1
            ids += c.tree([r[2] for r in rows_[i:j]])
            i = j
        return pa.table([table.column("doc_id").slice(0, 1), pa.array([ids], pa.list_(pa.int32())),
                         pa.array([c.decode(ids)], pa.string())], ["doc_id", "ids", "decoded"])

    short = rows.where(~long_).mapInArrow(whole, result)
    cut_up = rows.where(long_).select("doc_id", F.monotonically_increasing_id().alias("rid"), "text").mapInArrow(
        pieces, f"doc_id {key}, rid long, seq int, run int, parts array<string>")
    encoded = cut_up.repartition("rid", "seq").mapInArrow(
        leaves, f"doc_id {key}, rid long, seq int, run int, ids array<int>")
    return short.unionByName(encoded.groupBy("rid").applyInArrow(gather, result))


def encode_digest(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256."""
    return encode(docs, vocabulary, id_col, text_col).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
