"""SentencePiece encoding and decoding by a table of prefix tokens.

For a model whose merges are chosen by the score of the merged piece, the
encoding of a text is the one sequence whose neighbouring pieces are all
compatible: two pieces are when encoding them joined gives them back. Hence each
prefix of a text has one last piece, and it can be found from left to right: an
automaton lists the pieces that end at a position, and the one that is
compatible with the last piece of the prefix before it is stored. The pieces
are then recovered backwards from the end of the text. The work is linear in
the text. The automaton reads many short parts side by side and fills their
tables one position after the other, with numpy.

No piece spans a pair of characters that occurs inside no piece, so a long text
is cut at such pairs first; the results of short parts are kept.

Encoding and decoding equal the library's for models with an identity
normaliser, a leading dummy space, kept white space and byte fallback; others
are refused. The model is read once by the caller and travels as bytes.

Defined cases: a null text is an empty one; an empty text has only the begin
and end ids; null ids decode to an empty text. Extra columns pass through;
output columns replace columns of the same name. Texts are never cut or merged.
"""

from __future__ import annotations

import codecs
import functools
import itertools
import math
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliograph.llm.common import slices

SPACE = "▁"
#: Entries of the caches for parts, cores and pairs; a full cache starts anew.
PARTS, CORES, PAIRS = 150_000, 50_000, 500_000
#: Parts shorter than this are kept in the caches; characters of the tables that are filled side by side.
SHORT, SIDE_BY_SIDE = 100, 500_000
#: Fewer characters than this are encoded one text after the other.
FEW = 300
#: Bytes of texts that a task takes at once; a text of more characters than LARGE learns its parts alone, in groups.
TEXTS, LARGE = 2 << 20, 1 << 20
#: Runs of letters, of white space, of digits, of anything else: cuts lie between them.
CLASSES = re.compile(r"[^\W\d_]+|\s|[\d_]+|[^\w\s]+")
#: High bytes while they wait to be decoded, as in Python's surrogateescape.
ESCAPED = 0xDC00

codecs.register_error("one_by_one", lambda e: ("�", e.start + 1))


class PieceModel:
    """Encoder and decoder of one model, with its caches."""

    def __init__(self, model: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto()
        m.ParseFromString(model)
        norm, kind = m.normalizer_spec, proto.ModelProto.SentencePiece
        if norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces:
            raise ValueError("only models with identity normaliser and dummy prefix are supported")
        if m.trainer_spec.model_type != proto.TrainerSpec.BPE or not m.trainer_spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback are supported")
        self.begin, self.end = m.trainer_spec.bos_id, m.trainer_spec.eos_id
        self.pieces = [p.piece for p in m.pieces]
        self.score = {p.piece: p.score for p in m.pieces if p.type in (kind.NORMAL, kind.USER_DEFINED, kind.UNUSED)}
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.piece in self.score}
        self.bytes_id = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == kind.BYTE}
        # pairs looked at, in order: twice their number, plus one where they go together
        self.pairs = np.empty(0, np.int64)
        self.edges: dict[int, tuple[list, list]] = {}
        self.cores: dict[str, bytes] = {}
        self.pairs_inside = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.automaton, self.whole = ahocorasick.Automaton(), set()
        for p in self.score:
            if self.merged(p) == [p]:
                self.automaton.add_word(p, self.id[p])
                self.whole.add(p)
        self.automaton.make_automaton()
        self.size = np.array([len(p) for p in self.pieces])
        self.states = _States({p: self.id[p] for p in self.whole})
        # no piece spans a line feed: lines can be encoded one by one
        self.cut_lines = not any("\n" in p for p in self.pairs_inside)
        self.line_feed = self.together(["\n"])[0]
        # what each id adds to a decoded text
        self.shown = [p.replace(SPACE, " ") for p in self.pieces]
        for i, p in enumerate(m.pieces):
            if p.type == kind.CONTROL:
                self.shown[i] = ""
            elif p.type == kind.UNKNOWN:
                self.shown[i] = m.trainer_spec.unk_surface
            elif p.type == kind.BYTE:
                b = int(p.piece[3:5], 16)
                self.shown[i] = chr(b) if b < 128 else chr(ESCAPED + b)
        self.parts = _Parts(self)
        self.spaced = {i for i, p in enumerate(self.pieces) if p.startswith(SPACE)}
        self.control = {i for i, p in enumerate(m.pieces) if p.type == kind.CONTROL}

    def forget(self) -> None:
        """Empty the tables that grow with the texts."""
        self.parts.clear()
        self.cores.clear()
        self.edges.clear()

    def merged(self, text: str) -> list[str]:
        """Merge neighbours, best score first, then leftmost, until none can be merged (for short texts)."""
        symbols, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def edge(self, piece: int) -> tuple[list, list]:
        """First and last symbol of a piece before each of its merges and after them, each with the score of the merge to come."""
        known = self.edges.get(piece)
        if known is None:
            symbols, score = list(self.pieces[piece]), self.score
            first, last = [], []
            while len(symbols) > 1:
                scores = [score.get(a + b, -math.inf) for a, b in itertools.pairwise(symbols)]
                best = max(scores)
                first.append((symbols[0], best))
                last.append((symbols[-1], best))
                at = scores.index(best)
                symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            first.append((symbols[0], -math.inf))
            last.append((symbols[0], -math.inf))
            known = self.edges[piece] = first, last
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two stay as they are when they are encoded together.

        Each is merged as if alone until a merge over their border is the next
        one: it has the best score, or the same score and begins further left.
        """
        lasts, firsts = self.edge(left)[1], self.edge(right)[0]
        i, j, score = 0, 0, self.score.get
        while True:
            (a, ahead), (b, behind) = lasts[i], firsts[j]
            across = score(a + b)
            if across is not None and across > ahead and across >= behind:
                return False
            if i + 1 < len(lasts) and (j + 1 == len(firsts) or ahead >= behind):
                i += 1
            elif j + 1 < len(firsts):
                j += 1
            else:
                return True

    def fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`compatible` of each pair; the answers are kept."""
        asked = (left * len(self.pieces) + right) * 2
        at = np.searchsorted(self.pairs, asked)
        found = self.pairs[np.minimum(at, len(self.pairs) - 1)] if len(self.pairs) else np.full(len(asked), -1)
        new = found >> 1 != asked >> 1
        if new.any():
            keys = np.unique(asked[new])
            pairs = zip(*np.divmod(keys >> 1, len(self.pieces)), strict=True)
            answers = keys + np.fromiter((self.compatible(int(a), int(b)) for a, b in pairs), np.int64, len(keys))
            found[new] = answers[np.searchsorted(keys, asked[new])]
            if len(self.pairs) + len(answers) > PAIRS:
                self.pairs = answers[:PAIRS]
            else:
                self.pairs = np.insert(self.pairs, np.searchsorted(self.pairs, answers), answers)
        return found & 1 == 1

    def together(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that can be encoded alone, short ones in groups of bounded size."""
        if sum(map(len, texts)) < FEW:
            return [self.core(text) for text in texts]
        out: list[bytes] = [b""] * len(texts)
        group: list[int] = []
        total = 0
        for i, text in enumerate(texts):
            if len(text) >= SHORT:
                out[i] = self.core(text)
                continue
            group.append(i)
            total += len(text)
            if total > SIDE_BY_SIDE:
                for k, ids in zip(group, self.side_by_side([texts[k] for k in group]), strict=True):
                    out[k] = ids
                group, total = [], 0
        for k, ids in zip(group, self.side_by_side([texts[k] for k in group]), strict=True):
            out[k] = ids
        return out

    def side_by_side(self, texts: list[str]) -> list[bytes]:
        """:meth:`core` of each short text, position by position over all of them.

        ``last[i]`` is the last piece of the characters of a text that end at
        ``i`` of the joined texts.
        """
        if not texts:
            return []
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.cumsum(sizes + 1) - sizes - 1
        chars = np.frombuffer(" ".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        last = np.full(len(chars) + 1, -1)
        by_size = np.argsort(-sizes, kind="stable")
        reach = np.searchsorted(-sizes[by_size], -np.arange(1, sizes.max() + 1), "right")
        state = np.zeros(len(texts), np.int64)
        for i, k in enumerate(reach.tolist()):
            now = begin[by_size[:k]]
            state = self.states.after(state[:k], chars[now + i])
            piece, end = self.states.longest[state], now + i + 1
            todo = np.flatnonzero(piece >= 0)
            while len(todo):  # the longest piece that ends here, then the longest that ends it
                own = piece[todo]
                start = end[todo] - self.size[own]
                fits, before = start == now[todo], last[start]
                ask = np.flatnonzero(~fits & (before >= 0))
                fits[ask] = self.fitting(before[ask], own[ask])
                last[end[todo[fits]]] = own[fits]
                todo, own = todo[~fits], own[~fits]
                piece[todo] = self.states.within[own]
                todo = todo[piece[todo] >= 0]
        # back from the ends; a text with a character that is no piece is left to core
        missing = last < 0
        missing[begin] = False
        whole = np.ones(len(texts), bool)
        whole[np.searchsorted(begin, np.flatnonzero(missing), "right") - 1] = False
        at, who, steps = begin + sizes, np.flatnonzero(whole & (sizes > 0)), []
        while len(who):
            ids = last[at[who]]
            steps.append((who, ids))
            at[who] -= self.size[ids]
            who = who[at[who] > begin[who]]
        many = np.zeros(len(texts), np.int64)
        for owners, _ in steps:
            many[owners] += 1
        to = np.cumsum(many)
        flat, left = np.empty(int(to[-1]), "<u4"), to.copy()
        for owners, ids in steps:
            left[owners] -= 1
            flat[left[owners]] = ids
        data, cut = flat.tobytes(), [0, *(4 * to).tolist()]
        out = [data[a:b] for a, b in itertools.pairwise(cut)]
        for i in np.flatnonzero(~whole).tolist():
            out[i] = self.core(texts[i])
        return out

    def core(self, text: str) -> bytes:
        """Ids of a text that can be encoded alone, by its table of prefix tokens.

        ``last[i]`` is the last piece of the first ``i`` characters; where it is
        empty, a character that is no piece stands alone.
        """
        n, pieces, fits = len(text), self.pieces, {}
        last = [-1] * (n + 1)
        for end, piece in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - len(pieces[piece])
            if start:
                before = last[start] if last[start] >= 0 else text[start - 1]
                known = fits.get((before, piece))
                if known is None:
                    if len(fits) >= CORES:
                        fits.clear()
                    if last[start] >= 0:
                        known = self.compatible(before, piece)
                    else:
                        known = self.merged(before + pieces[piece]) == [before, pieces[piece]]
                    fits[before, piece] = known
                if not known:
                    continue
            last[end] = piece
        found: list[int] = []
        while n:
            piece = last[n]
            if piece >= 0:
                found.append(piece)
                n -= len(pieces[piece])
            else:
                n -= 1
                found += [self.bytes_id[b] for b in reversed(text[n].encode())]
        found.reverse()
        return array("I", found).tobytes()

    def cut(self, text: str) -> list[str]:
        """A text with marked spaces, cut where no piece can span."""
        inside, core, cores = self.pairs_inside, "", []
        for run in CLASSES.findall(text):
            if core and core[-1] + run[0] not in inside:
                cores.append(core)
                core = run
            else:
                core += run
        return [*cores, core] if core else cores

    def run(self, text: str) -> bytes:
        """Ids of a text with marked spaces."""
        cores, known, out = self.cut(text), self.cores, []
        for a in range(0, len(cores), CORES // 2):
            some = cores[a : a + CORES // 2]
            self.need(set(some))
            out += [known[c] if c in known else self.core(c) for c in some]
        return b"".join(out)

    def need(self, cores: set[str]) -> None:
        """Encode the cores that are new, at once; a full table keeps only those of ``cores``, and long ones are not kept."""
        known = self.cores
        new = [c for c in cores.difference(known) if len(c) < SHORT]
        if len(known) + len(new) > CORES:
            kept = {c: known[c] for c in cores.intersection(known)}
            known.clear()
            known.update(kept)
        known.update(zip(new, self.together(new), strict=True))

    def split(self, text: str) -> list[str] | None:
        """Parts of a text that are encoded one by one, or nothing where only the whole can be.

        Each has a space before it; where lines can be cut, one that begins with a line feed has none.
        """
        if text[0] == " " or "  " in text or SPACE in text:
            return None
        return (text.replace("\n", " \n") if self.cut_lines else text).split(" ")

    def learn(self, texts: Iterable[str | None]) -> None:
        """Encode the parts of several texts that are not known yet, all at once."""
        needed: set[str] = set()
        cores: set[str] = set()
        for text in texts:
            if text and len(text) < LARGE:
                parts = self.split(text)
                if parts is not None:
                    needed.update(parts)
                elif len(cores) < CORES // 2:
                    cores.update(self.cut(self.spaced_out(text)))
        self.parts.need(needed)
        self.need(cores)

    def spaced_out(self, text: str) -> str:
        return SPACE + text.replace(" ", SPACE)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.split(text)
        if parts is None:
            return self.run(self.spaced_out(text))
        if len(text) < LARGE:
            return b"".join(map(self.parts.__getitem__, parts))
        out = []
        for a in range(0, len(parts), PARTS // 2):
            some = parts[a : a + PARTS // 2]
            self.parts.need(set(some))
            out += map(self.parts.__getitem__, some)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        listed = ids.tolist()
        text = "".join(map(self.shown.__getitem__, listed))
        for first in listed:
            if first not in self.control:
                if first in self.spaced:
                    text = text[1:]
                break
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "one_by_one")
        return text


class _States:
    """The automaton of the pieces, as arrays, for many texts at a time."""

    def __init__(self, pieces: dict[str, int]):
        nodes = {"": 0}
        for p in sorted(pieces, key=len):
            for i in range(1, len(p) + 1):
                if p[:i] not in nodes:
                    nodes[p[:i]] = len(nodes)
        ends = sorted(nodes, key=len)
        fail, longest, within = [0] * len(nodes), [-1] * len(nodes), {}
        for text in ends[1:]:
            node = nodes[text]
            back = next((nodes[text[i:]] for i in range(1, len(text)) if text[i:] in nodes), 0)
            fail[node] = back
            longest[node] = pieces.get(text, longest[back])
            if text in pieces:
                within[pieces[text]] = longest[back]
        self.fail, self.longest = np.array(fail), np.array(longest)
        self.within = np.full(max(pieces.values()) + 1, -1)
        self.within[list(within)] = list(within.values())
        # steps (state, character) to a state, as a hash table with open places
        self.bits = (4 * len(nodes)).bit_length()
        keys = np.array([nodes[t[:-1]] << 21 | ord(t[-1]) for t in ends[1:]])
        values = np.array([nodes[t] for t in ends[1:]])
        self.keys, self.values = np.full((1 << self.bits) + 64, -1), np.full((1 << self.bits) + 64, -1)
        place = self.place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]
            self.values[place[free]] = values[free]
            left = self.keys[place] != keys  # of several that ask for a free place, the last has it
            keys, values, place = keys[left], values[left], place[left] + 1

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """State behind a character, or -1."""
        keys = state << 21 | char
        place = self.place(keys)
        found, out = self.keys[place], self.values[place]
        other = np.flatnonzero((found != keys) & (found >= 0))
        out[found < 0] = -1
        while len(other):
            place[other] += 1
            found = self.keys[place[other]]
            out[other] = np.where(found == keys[other], self.values[place[other]], -1)
            other = other[(found != keys[other]) & (found >= 0)]
        return out

    def after(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """State of each text after one more character."""
        new = self.child(state, char)
        todo = np.flatnonzero((new < 0) & (state > 0))
        state = state.copy()
        while len(todo):
            state[todo] = self.fail[state[todo]]
            new[todo] = self.child(state[todo], char[todo])
            todo = todo[(new[todo] < 0) & (state[todo] > 0)]
        return np.maximum(new, 0)


class _Parts(dict):
    """Ids of each part between single spaces, with the space or line feed before it."""

    def __init__(self, model: PieceModel):
        self.model = model

    def need(self, parts: set[str]) -> None:
        """Encode the parts that are new, at once; a full table keeps only those of ``parts``, and long ones are not kept."""
        new = [p for p in parts.difference(self) if len(p) < SHORT]
        if len(self) + len(new) > PARTS:
            kept = {p: self[p] for p in parts.intersection(self)}
            self.clear()
            self.update(kept)
        marked = [self.marked(p) for p in new]
        for part, ids in zip(new, self.model.together([text for text, _ in marked]), strict=True):
            self[part] = ids
        for part, (_, feed) in zip(new, marked, strict=True):
            if feed:
                self[part] = feed + self[part]

    def marked(self, part: str) -> tuple[str, bytes]:
        """A part as it is encoded, and the ids of a line feed before it."""
        if self.model.cut_lines and part[:1] == "\n":
            return part[1:], self.model.line_feed
        return SPACE + part, b""

    def __missing__(self, part: str) -> bytes:
        text, feed = self.marked(part)
        ids = feed + self.model.run(text)
        if len(part) < SHORT:
            if len(self) >= PARTS:
                self.clear()
            self[part] = ids
        return ids


@functools.lru_cache(maxsize=2)
def piece_model(model: bytes) -> PieceModel:
    return PieceModel(model)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _with_columns(df: DataFrame, source: str, added: dict[str, T.DataType], model: bytes, fn, learn: bool = False) -> DataFrame:
    """``df`` with the columns ``added`` = ``fn`` of each value of ``source``, in batches of bounded size; with ``learn`` the parts of a batch are encoded at once. The model's tables end with the task."""
    schema = T.StructType([f for f in df.schema if f.name not in added] + [T.StructField(n, t) for n, t in added.items()])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for start, end in slices(batch.column(source), TEXTS):
                    part = batch.slice(start, end - start)
                    values = part.column(source).to_pylist()
                    if learn:
                        piece_model(model).learn(values)
                    rows = [fn(x) for x in values]
                    new = {n: pa.array([r[i] for r in rows], arrow.field(n).type) for i, n in enumerate(added)}
                    yield pa.RecordBatch.from_arrays([new[f.name] if f.name in new else part.column(f.name).cast(f.type) for f in arrow], schema=arrow)
        finally:  # the worker may go on with other work
            piece_model(model).forget()

    return df.mapInArrow(run, schema)


def _encoded(model: bytes, value: str | None, ends: bool) -> bytes:
    m = piece_model(model)
    body = m.encode(value or "")
    return np.array([m.begin], "<u4").tobytes() + body + np.array([m.end], "<u4").tobytes() if ends else body


def _decoded(model: bytes, ids: bytes | None) -> str:
    return piece_model(model).decode(np.frombuffer(ids or b"", "<u4"))


def encode(df: DataFrame, model: bytes, text: str = "text", ids: str = "token_ids", ends: bool = True) -> DataFrame:
    """``df`` with ``ids``: the whole text's ids as little-endian unsigned 32-bit integers."""
    return _with_columns(df, text, {ids: T.BinaryType()}, model, lambda x: (_encoded(model, x, ends),), learn=True)


def decode(df: DataFrame, model: bytes, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text`` decoded from ``ids``."""
    return _with_columns(df, ids, {text: T.StringType()}, model, lambda x: (_decoded(model, x),))


def encode_and_decode(
    df: DataFrame, model: bytes, text: str = "text", ids: str = "token_ids", decoded: str = "decoded", ends: bool = True
) -> DataFrame:
    """``df`` with ``ids`` of ``text`` and the text ``decoded`` from them, by one Python worker where two steps take two."""

    def both(value: str | None) -> tuple[bytes, str]:
        found = _encoded(model, value, ends)
        return found, _decoded(model, found)

    return _with_columns(df, text, {ids: T.BinaryType(), decoded: T.StringType()}, model, both, learn=True)
