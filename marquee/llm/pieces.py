"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

The encoder finds, for every place of a chunk, the longest vocabulary piece that starts there (Aho-Corasick over the reversed
chunk), then walks from left to right: take the longest piece that leads to a place not yet known to fail and that is
compatible with the piece before it; otherwise try the next shorter prefix; otherwise mark the place as failed in a bitfield
and step back. Two pieces are compatible if merging their joined characters anew gives exactly these two. A sequence of
pairwise compatible pieces is what the merges give for the whole chunk, so no agenda over the text is needed.

Chunks are runs of the space mark with the word after them: no piece of a supported model holds a space mark after
another character, so no merge crosses a chunk. Characters without a piece become their UTF-8 byte pieces. The vocabulary file
is read through the sentencepiece library, its path is a parameter, and each Python worker reads it once.

Edge cases: null and empty texts have no ids and decode to the empty text; the space mark U+2581 in a text is read as a space
(as the library does); repeated rows give repeated results; texts of any length are encoded whole (memory in proportion to
the text). Models that normalise, drop spaces or have no byte pieces are refused.
"""
from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import quoted

MARK = "▁"
CACHE_CHUNKS, CACHE_CHUNK_CHARS, CACHE_PAIRS, OUT_ROWS, INF = 250_000, 64, 400_000, 256, float("inf")


class PieceCodec:
    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        self.byte_id, self.id_byte, self.silent, merges = {}, {}, set(), {}
        for i, p in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte_id[int(p[3:-1], 16)] = i
                self.id_byte[i] = int(p[3:-1], 16)
            elif sp.is_control(i):
                self.silent.add(i)
            elif not (sp.is_unknown(i) or sp.is_unused(i)):
                merges[p] = (-sp.get_score(i), i)
        if len(self.byte_id) < 256 or any(MARK in p.lstrip(MARK) for p in merges):
            raise ValueError("only models with byte pieces and without a space inside a piece are supported")
        runs = {s for p, (s, _) in merges.items() if p.startswith(MARK * 2)}
        if len(runs) > 1 or any(p.startswith(MARK * 2) and p.strip(MARK) for p in merges) or runs and max(runs) < max(merges.values())[0]:
            raise ValueError("only models whose runs of spaces merge last and among themselves are supported")
        if sp.encode(" a  b ", out_type=str) != [MARK, f"{MARK}a", MARK, f"{MARK}b", MARK]:
            raise ValueError("only models that keep white space and add a prefix space are supported")
        self.unk_text = sp.decode([sp.unk_id()])
        self.unk = sp.unk_id()
        self.merges, self.pair = merges, {}
        self.cost = {p: c for p, (c, _) in merges.items()}.get
        self.known = {c for p in merges for c in p}
        # pieces that merging can reach; the others never come out of an encoding
        reach = [p for p in merges if len(p) == 1 or self.remerge(p) == [p]]
        self.id = {p: merges[p][1] for p in reach}
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.id), None) for p in reach}
        self.backward = ahocorasick.Automaton()
        for p in reach:
            self.backward.add_word(p[::-1], p)
        self.backward.make_automaton()
        lone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in self.known)
        self.chunk = re.compile(f"{MARK}+[^{MARK}{lone}]*|[^{MARK}{lone}]+|[{lone}]" if lone else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        # two generations: what is in use moves to the young one, the rest goes with the old one
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.plain = True

    def remerge(self, text: str) -> list[str]:
        """The merges themselves, best score first and leftmost on ties; for short texts."""
        parts, cost = list(text), self.cost
        costs = [cost(a + b, INF) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) < INF:
            i = costs.index(least)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = cost(parts[i] + parts[i + 1], INF)
            if i:
                costs[i - 1] = cost(parts[i - 1] + parts[i], INF)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        ok = self.pair.get(key)
        if ok is None:
            if len(self.pair) > CACHE_PAIRS:
                self.pair.clear()
            ok = self.pair[key] = self.remerge(left + right) == [left, right]
        return ok

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text of known characters."""
        n = len(text)
        longest: list = [None] * n
        for end, piece in self.backward.iter(text[::-1]):
            start = n - 1 - end
            if longest[start] is None:  # the matches that end in one place come longest first
                longest[start] = piece
        open_at = bytearray(b"\x01") * (n + 1)  # 0: no encoding goes on from here
        out: list[str] = []
        at, piece = 0, longest[0] if n else None
        while at < n:
            last = out[-1] if out else None
            while piece is not None and not (open_at[at + len(piece)] and (last is None or self.compatible(last, piece))):
                piece = self.shorter[piece]
            if piece is not None:
                out.append(piece)
                at += len(piece)
                piece = longest[at] if at < n else None
            else:
                if last is None:
                    raise ValueError("no encoding")  # cannot happen: every known character is a piece
                open_at[at] = 0
                piece = out.pop()
                at -= len(piece)
        return out

    def encode_chunk(self, chunk: str) -> list[int]:
        ids: list[int] = []
        if chunk in self.id:  # reachable, so it is its own encoding
            return [self.id[chunk]]
        if self.known.issuperset(chunk):
            return [self.id[p] for p in self._runs(chunk)]
        run = 0
        for i, c in enumerate(chunk):
            if c not in self.known:
                ids += [self.id[p] for p in self._runs(chunk[run:i])]
                ids += [self.byte_id[b] for b in c.encode("utf-8", "surrogatepass")]
                run = i + 1
        return ids + [self.id[p] for p in self._runs(chunk[run:])]

    def _runs(self, text: str) -> list[str]:
        """Spaces before the last one merge with each other only; all their merges have one score, so they go from the left."""
        body = text.lstrip(MARK)
        ahead = len(text) - len(body)
        if ahead < 2:
            return self.backtrack(text)
        rest = self.backtrack(text[ahead - 1:]) if body else []
        alone = ahead - 1 if rest and rest[0] != MARK else ahead
        return self.spaces(alone) + (rest if alone < ahead else rest[1:])

    @lru_cache(maxsize=4096)  # noqa: B019 - one codec lives as long as its worker
    def spaces(self, n: int) -> list[str]:
        out: list[str] = []
        for _ in range(n):
            out.append(MARK)
            while len(out) > 1 and out[-2] + out[-1] in self.merges:
                out[-2:] = [out[-2] + out[-1]]
        return out

    def decode(self, ids: list[int], start: bool = True) -> str:
        """Text of ids; at a start the prefix space goes. Bytes that are no UTF-8 become U+FFFD, one each."""
        out, held = [], bytearray()
        for i in [*ids, None]:
            if i in self.id_byte:
                held.append(self.id_byte[i])
                continue
            while held:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(held[:n].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    n = 1
                del held[:n]
            if i is not None and i not in self.silent:
                out.append(self.unk_text if i == self.unk else self.pieces[i].replace(MARK, " "))
        text = "".join(out)
        return text[1:] if start and ids and self.pieces[ids[0]].startswith(MARK) else text

    def _miss(self, chunk: str) -> str:
        """Comma-joined ids of a chunk that the young cache lacks; also checks that its ids decode to the chunk."""
        made = self.old.get(chunk)
        if made is None:
            ids = self.encode_chunk(chunk)
            made = ",".join(map(str, ids))
            if self.decode(ids, start=False) != chunk.replace(MARK, " "):
                self.plain = False
                return made
        if len(chunk) <= CACHE_CHUNK_CHARS:
            if len(self.young) >= CACHE_CHUNKS:
                self.old, self.young = self.young, {}
            self.young[chunk] = made
        return made

    def process(self, text: str) -> tuple[str, int, str]:
        """(comma-joined ids, number of ids, decoded text) of a whole text."""
        if not text:
            return "", 0, ""
        self.plain, get, miss = True, self.young.get, self._miss
        marked = MARK + text.replace(" ", MARK)
        ids = ",".join([get(c) or miss(c) for c in self.chunk.findall(marked)])
        decoded = marked.replace(MARK, " ")[1:] if self.plain else self.decode([int(i) for i in ids.split(",")])
        return ids, ids.count(",") + 1, decoded

    def encode(self, text: str) -> list[int]:
        ids = self.process(text)[0]
        return [int(i) for i in ids.split(",")] if ids else []


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    return PieceCodec(model_file)


def encode_documents(docs: DataFrame, model_file: str, text_col: str = "text", keep: tuple[str, ...] | None = None,
                     ids: str = "ids", decoded: str | None = "decoded") -> DataFrame:
    """The columns named in ``keep`` (default: all but those named like a result), ids array<int> and, unless decoded is
    None, the text that they decode to. Rows leave in small batches, so a task holds few results at a time."""
    keep = tuple(c for c in docs.columns if c not in (ids, decoded)) if keep is None else tuple(keep)
    # by number on the way in: mapInArrow looks names up unquoted
    rows = docs.select(*[F.col(quoted(c)).alias(f"__{i}") for i, c in enumerate(keep)], F.col(text_col).alias("__text"))
    kept = [T.StructField(c, f.dataType) for c, f in zip(keep, rows.schema.fields)]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if decoded:
        schema.add(decoded, T.StringType())

    def run(batches):
        c = codec(model_file)
        for b in batches:
            for i in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(i, OUT_ROWS)
                made = [c.process(t or "") for t in part.column(len(keep)).to_pylist()]
                values = np.fromstring(",".join(m[0] for m in made if m[1]), dtype=np.int32, sep=",")
                ends = np.cumsum([0] + [m[1] for m in made], dtype=np.int32)
                out = [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
                if decoded:
                    out.append(pa.array([m[2] for m in made], pa.string()))
                yield pa.RecordBatch.from_arrays(out, schema.names)

    return rows.mapInArrow(run, schema)


def token_digests(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(texts: pd.Series) -> pd.DataFrame:
        c, rows = codec(model_file), []
        for t in texts:
            ids, n, decoded = c.process(t or "")
            rows.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias(id_col), run(F.col(text_col)).alias("d")).select(id_col, "d.*")
