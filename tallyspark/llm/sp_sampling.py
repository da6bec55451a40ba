"""SentencePiece segmentations sampled without replacement.

Pieces of a SentencePiece model span a lattice over the text; a piece's weight
is a power law of its rank, and bytes stand for characters without a piece.
No piece crosses from a word into the next one's leading spaces.  The lattices
of a block of texts are built together in numpy arrays: a trie finds all pieces
at all characters, and exact backward sums between the lattice's cuts (places
that no piece passes over) give every edge its probability.

Gumbel top-k by a perturbed A-star search, top down: the best perturbed value
of a region (a prefix that is fixed, at the next choice some alternatives
excluded, the rest free) is known before it is opened.  Opening the best
region samples its arg max path and leaves, for every choice on the path, a
region of all other alternatives there, whose value is a Gumbel truncated at
the opened one.  The k paths popped first are k distinct segmentations drawn
without replacement; the best value left in the queue is the threshold of the
inclusion scores 1 - exp(-exp(log p - threshold)).  Random numbers come from
the row key alone.

Rows: a null or empty text has one segmentation of no pieces (inclusion 1); a
null doc_id seeds as -1; repeated rows give the same samples.  A text with
fewer than k segmentations gives all of them.  A task holds one block of
``GRAPH_BYTES`` at a time, about 300 bytes for each byte of it; a longer text
makes its own block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspark.llm.common import chunks, flat_bytes, mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
K = 2
SEED = 20
GRAPH_BYTES = 1 << 16  # text bytes of the lattices built together (a longer text makes its own)
SPACE = "▁"
ESCAPE = 0xD800  # stands for a literal U+2581; no valid text holds it
END = 0x110000  # the node behind a text, beyond all code points
PER_CHAR = 3.0  # log scale of a character in the backward sums; paths between cuts share it, so it cancels
TINY = 1e-280  # sums below it are taken in logarithms instead
U = np.uint64

SCHEMA = "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, inclusion double, ids array<int>"
COLS = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids"]
TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.list_(pa.int32())]


def logsub(a, b):
    """log(exp(a) - exp(b)) for a >= b."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return a + np.log(-np.expm1(np.minimum(b - a, 0.0)))


def stream_keys(keys: np.ndarray, stream: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(keys + U(stream) * U(0x9E3779B97F4A7C15))


def uniform(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on row key, stream and position alone."""
    with np.errstate(over="ignore"):
        x = mix64(keys + at.astype(U) * U(0xD1342543DE82EF95))
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattice:
    """Pieces and weights of a model, as a trie in flat arrays."""

    shared: dict = {}

    @classmethod
    def of(cls, model: str) -> Lattice:
        """The worker's lattice of a model, built once per process."""
        if model not in cls.shared:
            cls.shared[model] = cls(model)
        return cls.shared[model]

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.back = {i: int(sp.id_to_piece(i)[1:-1], 16) for i in range(size) if sp.is_byte(i)}
        self.byte_ids = np.zeros(256, np.int32)
        self.byte_ids[list(self.back.values())] = list(self.back)
        self.text = {i: sp.id_to_piece(i) for i in plain}
        order = sorted(plain, key=lambda i: -sp.get_score(i))
        self.weight = np.zeros(size)
        self.weight[order] = -1.1 * np.log(np.arange(len(order)) + 20.0)
        self.byte_cost = -1.1 * math.log(size + 20) - 4.0
        chars = np.zeros(size)
        chars[plain] = [len(self.text[i]) for i in plain]
        self.scaled = np.exp(self.weight + PER_CHAR * chars)
        self._trie()

    def _trie(self) -> None:
        """Nodes of all prefixes; node 0 is none.  A step is a lookup of
        (node, character) in an open hash table, the first one by character."""
        node, ids = {}, [-1]
        for i, piece in self.text.items():
            if SPACE in piece.lstrip(SPACE):
                continue  # no piece crosses from a word into the next one's spaces
            for end in range(1, len(piece) + 1):
                if piece[:end] not in node:
                    node[piece[:end]] = len(ids)
                    ids.append(-1)
            ids[node[piece]] = i
        self.piece = np.array(ids, np.int32)
        self.first = np.zeros(END + 1, np.int32)
        steps = []
        for prefix, n in node.items():
            if len(prefix) == 1:
                self.first[ord(prefix)] = n
            else:
                steps.append((node[prefix[:-1]] << 21 | ord(prefix[-1]), n))
        self.bits = max(10, (4 * len(steps)).bit_length())
        self.table = np.zeros(1 << self.bits, U)  # (node, character) and the node behind, 0 if free
        assert len(ids) < 1 << 21
        for (key, n), s in zip(steps, self._slot(np.array([k for k, _ in steps], U)).tolist(), strict=True):
            while self.table[s]:
                s = (s + 1) & ((1 << self.bits) - 1)
            self.table[s] = key << 21 | n

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((key * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = (node.astype(U) << U(21)) | char
        slot = self._slot(key)
        got = self.table[slot]
        out = got & U((1 << 21) - 1)
        other = np.flatnonzero((got >> U(21)) != key)
        out[other] = 0
        todo = other[got[other] > 0]
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            got = self.table[slot[todo]]
            hit = (got >> U(21)) == key[todo]
            out[todo[hit]] = got[hit] & U((1 << 21) - 1)
            todo = todo[~hit & (got > 0)]
        return out.astype(np.int64)

    def decode(self, ids) -> str:
        raw = b"".join(bytes([self.back[i]]) if i in self.back else self.text[i].replace(SPACE, " ").encode() for i in ids)
        return raw.decode()[1:] if raw else ""


class Graph:
    """Lattices of several texts in flat arrays: a node per character, one at
    each text's end, and the edges of a node next to each other."""

    def __init__(self, lattice: Lattice, texts: list[str]):
        parts, size = [], [0]
        for t in texts:
            codes = np.frombuffer((" " + t).encode("utf-32-le") if t else b"", np.uint32)
            parts += [codes, np.array([END], np.uint32)]
            size.append(len(codes) + 1)
            if SPACE in t:  # a literal U+2581 is kept apart from a space
                parts[-2] = np.where(codes == ord(SPACE), ESCAPE, codes)
        chars = np.concatenate(parts)
        chars[chars == 32] = ord(SPACE)
        self.lattice, self.chars, self.doc = lattice, chars, np.cumsum(size)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), size[1:])
        self._edges()
        self._weigh()

    def _edges(self) -> None:
        """Matches of all pieces at all nodes; bytes where no piece has the
        single character; one edge leads out of each text's end."""
        n, chars, trie = len(self.chars), self.chars, self.lattice
        node, found, depth = trie.first[chars], [], 1
        at = np.flatnonzero(node)
        node = node[at]
        one = np.zeros(n, bool)
        while len(at):
            ids = trie.piece[node]
            ends = ids >= 0
            found.append((depth, at[ends], ids[ends]))
            if depth == 1:
                one[at[ends]] = True
                found.insert(0, (1, np.flatnonzero(~one), None))  # first of their nodes' edges
            node = trie.step(node, chars[at + depth])
            more = np.flatnonzero(node)
            at, node, depth = at[more], node[more], depth + 1
        if not found:
            found.append((1, np.arange(n), None))
        degree = np.bincount(np.concatenate([where for _, where, _ in found]), minlength=n).astype(np.int32)
        self.start = np.zeros(n + 1, np.int64)
        np.cumsum(degree, out=self.start[1:])
        free = self.start[:-1].copy()
        total = int(self.start[-1])
        self.ids, self.to = np.full(total, -1, np.int32), np.zeros(total, np.int32)
        for length, where, ids in found:
            slot = free[where]
            self.to[slot] = where + length
            if ids is not None:
                self.ids[slot] = ids
            free[where] += 1
        self.degree, self.bare = degree, found[0][1]

    def _weigh(self) -> None:
        """Probabilities of the edges, from exact backward sums.  No edge
        passes over a cut, so the stretches between cuts are summed together,
        node after node from their ends."""
        n, start, degree = len(self.chars), self.start, self.degree
        raw, char = start[self.bare], self.chars[self.bare]
        raw_weight = np.where(char == END, 0.0, self.lattice.byte_cost * utf8_length(char))
        cut = np.ones(n + 1, bool)
        cut[1:] = np.maximum.accumulate(np.maximum.reduceat(self.to, start[:-1])) <= np.arange(1, n + 1)
        cuts = np.flatnonzero(cut)
        away = np.repeat(cuts[1:], np.diff(cuts)) - np.arange(n)
        self.cut = cut
        small = np.uint16 if away.max() < 1 << 16 else np.int64
        nodes = np.argsort(away.astype(small), kind="stable")
        deg = degree[nodes]
        begin = np.cumsum(deg) - deg
        edges = np.repeat(start[nodes] - begin, deg) + np.arange(len(self.ids))
        targets, cut_at = self.to[edges], cut[nodes]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(away)[1:])])
        begin = np.append(begin, len(edges))

        def backward(weight: np.ndarray, join, times, one: float) -> tuple[np.ndarray, np.ndarray]:
            """Sums from a node on, and the same but ``one`` at a cut."""
            weights, sums, after = weight[edges], np.empty(n), np.full(n + 1, one)
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if i < j:
                    lo, hi = begin[i], begin[j]
                    got = join.reduceat(times(weights[lo:hi], after[targets[lo:hi]]), begin[i:j] - lo)
                    sums[nodes[i:j]] = got
                    after[nodes[i:j]] = np.where(cut_at[i:j], one, got)
            return sums, after

        # plain sums of weights scaled by the character; logarithms where a long stretch leaves their range
        weight = self.lattice.scaled[np.maximum(self.ids, 0)]
        weight[raw] = np.exp(raw_weight + PER_CHAR)
        with np.errstate(over="ignore"):
            sums, after = backward(weight, np.add, np.multiply, 1.0)
        if sums.min() > TINY and sums.max() < 1 / TINY:
            p = weight
            p *= after[self.to]
            p *= np.repeat(1.0 / sums, degree)
        else:
            weight = self.lattice.weight[np.maximum(self.ids, 0)]
            weight[raw] = raw_weight
            sums, after = backward(weight, np.logaddexp, np.add, 0.0)
            p = np.exp(weight + after[self.to] - np.repeat(sums, degree))
        self.p = np.minimum(p, 1.0, out=p)
        self.upto = np.cumsum(self.p)  # over all edges; before a node's: ``base``
        self.base = self.upto[start[:-1]] - self.p[start[:-1]]

    def node_of(self, edges) -> np.ndarray:
        return np.searchsorted(self.start, edges, side="right") - 1

    def draws(self, keys: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Random numbers at nodes, from their text's key and place in it."""
        text = self.text[nodes]
        return uniform(keys[text], nodes - self.doc[text])

    def lp(self, edges: np.ndarray) -> np.ndarray:
        """Log-probabilities of some edges."""
        return np.log(self.p[edges])

    def choose(self, nodes: np.ndarray, draws: np.ndarray) -> np.ndarray:
        """An edge for each of the nodes, by its probabilities."""
        first = self.start[nodes]
        at = np.searchsorted(self.upto, self.base[nodes] + draws, side="right")
        return np.clip(at, first, first + self.degree[nodes] - 1)

    def paths(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes on the sampled paths that start at every cut, and the edges
        that lead on from them; random numbers come from the texts' ``keys``."""
        choice = np.full(len(self.chars) + 1, -1)
        at = np.flatnonzero(self.cut[:-1])
        while len(at):
            choice[at] = self.choose(at, self.draws(keys, at))
            at = self.to[choice[at]]
            at = at[~self.cut[at]]
        nodes = np.flatnonzero(choice >= 0)
        return nodes, choice[nodes]

    def pieces(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of paths; a character without a piece gives its bytes."""
        edges = np.concatenate(paths)
        ends = np.cumsum([len(p) for p in paths])
        ids = self.ids[edges]
        raw = np.flatnonzero(ids < 0)
        if len(raw):
            char = self.chars[self.node_of(edges[raw])].astype(np.int64)
            char[char == ESCAPE] = ord(SPACE)
            count = np.ones(len(ids), np.int64)
            count[raw] = utf8_length(char)
            upto = np.cumsum(count)
            ends = np.concatenate([[0], upto])[ends]
            ids = np.repeat(ids, count)
            for c, b in zip(char.tolist(), (upto - count)[raw].tolist(), strict=True):
                code = chr(c).encode()
                ids[b : b + len(code)] = self.lattice.byte_ids[list(code)]
        return np.split(ids, ends[:-1])


def utf8_length(char: np.ndarray) -> np.ndarray:
    return 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)


def gumbel_of(draw: float) -> float:
    return float(-math.log(-math.log(draw)))


def truncated(phi: np.ndarray, most, draws: np.ndarray) -> np.ndarray:
    """Gumbel(phi) values conditioned to lie below ``most``; none for -inf."""
    with np.errstate(over="ignore", divide="ignore"):
        return -np.logaddexp(-most, -phi + np.log(-np.log(draws)))


def regions(graph: Graph, node: np.ndarray, lp: np.ndarray, before: np.ndarray, most, draws: np.ndarray) -> np.ndarray:
    """Perturbed values of all that leaves a path at its nodes, below ``most``."""
    phi = np.where(graph.degree[node] > 1, before + logsub(0.0, lp), -math.inf)
    return truncated(phi, most, draws)


def first_paths(graph: Graph, sampled: tuple, gumbel: np.ndarray, values: np.ndarray) -> Iterator[tuple]:
    """(path, log-probabilities, values of its regions) of every text's first
    sample, which the paths from the cuts make up; all texts at once."""
    nodes, edges = sampled
    a, b = graph.doc[:-1], graph.doc[1:] - 1
    lo, hi = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    lp = graph.lp(edges)
    text = graph.text[nodes]
    before = np.cumsum(lp) - lp
    before -= before[lo][text]
    rest = regions(graph, nodes, lp, before, values[text], uniform(gumbel[text], nodes - a[text]))
    for i, j in zip(lo.tolist(), hi.tolist(), strict=True):
        yield edges[i:j], lp[i:j], rest[i:j]


def search(graph: Graph, doc: int, first: tuple, sampled: list, keys: list, gumbel: list, scalars: np.ndarray, k: int):
    """(edges, log-probability, perturbed value, inclusion score) of the top k
    paths of a text.  ``first`` is its first path; per path, ``sampled`` holds
    the nodes and edges that lead from all cuts, ``keys`` the random stream of
    its choices, ``gumbel`` that of its regions, both by text."""
    a, b = int(graph.doc[doc]), int(graph.doc[doc + 1]) - 1

    def walk(at: int, r: int) -> np.ndarray:
        head = []
        while not graph.cut[at]:  # inside a stretch: on to its end
            here = np.array([at])
            head.append(int(graph.choose(here, graph.draws(keys[r], here))[0]))
            at = int(graph.to[head[-1]])
        nodes, edges = sampled[r]
        lo, hi = np.searchsorted(nodes, (at, b))
        return np.concatenate([np.array(head, np.int64), edges[lo:hi]])

    value = gumbel_of(scalars[0])
    paths, lps, rests, gone, found = [], [], [], {}, []
    while True:
        r = len(paths)
        if r == 0:
            path, lp, rest = first
        else:
            lp = graph.lp(path)
            rest = np.full(len(path), -math.inf)
            if begin < len(path):
                node = graph.node_of(path[begin:])
                before = (np.cumsum(lp) - lp)[begin:]
                rest[begin:] = regions(graph, node, lp[begin:], before, value, uniform(gumbel[r][doc], node - a))
        paths.append(path)
        lps.append(lp)
        rests.append(rest)
        found.append((path, float(lp.sum()), value))
        tops = [float(x.max()) if len(x) else -math.inf for x in rests]
        value = max(tops)
        if value == -math.inf or len(found) == k:
            break
        # Open the best region: another edge at its choice, the rest free.
        old = tops.index(value)
        at = int(rests[old].argmax())
        node = int(graph.node_of(paths[old][at]))
        out = gone.get((old, at), [int(paths[old][at])])
        free = [e for e in range(int(graph.start[node]), int(graph.start[node + 1])) if e not in out]
        p = graph.p[free]
        pick = min(int(np.searchsorted(np.cumsum(p), scalars[2 * r + 1] * p.sum(), side="right")), len(free) - 1)
        gone[old, at] = out + [free[pick]]
        mass = float(np.delete(p, pick).sum())
        left = float(lps[old][:at].sum()) + math.log(mass) if mass > 0 else -math.inf
        rests[old][at] = truncated(np.array([left]), value, scalars[2 * r + 2 : 2 * r + 3])[0]
        path = np.concatenate([paths[old][:at], [free[pick]], walk(int(graph.to[free[pick]]), r + 1)])
        begin = at + 1
    score = lambda lp: 1.0 if value == -math.inf else -math.expm1(-math.exp(min(700.0, lp - value)))
    return [(path, lp, v, score(lp)) for path, lp, v in found]


def sample_texts(lattice: Lattice, texts: list[str], keys: list[int], k: int = K, seed: int = SEED) -> Iterator[list[tuple]]:
    """Per text (ids, log-probability, perturbed value, inclusion score) of
    its top k segmentations."""
    graph = Graph(lattice, texts)
    with np.errstate(over="ignore"):
        key = mix64(np.array([x & 0xFFFFFFFFFFFFFFFF for x in keys], U) + U(seed) * U(0xBF58476D1CE4E5B9))
    keys = [stream_keys(key, 2 * r + 1) for r in range(k)]
    sampled = [graph.paths(own) for own in keys]
    gumbel = [stream_keys(key, 2 * r + 2) for r in range(k)]
    scalars = uniform(stream_keys(key, 0)[:, None], np.arange(2 * k + 1)[None, :])
    first = first_paths(graph, sampled[0], gumbel[0], np.array([gumbel_of(x) for x in scalars[:, 0].tolist()]))
    found = [search(graph, doc, f, sampled, keys, gumbel, scalars[doc], k) for doc, f in enumerate(first)]
    ids = iter(graph.pieces([path for got in found for path, *_ in got]))
    for got in found:
        yield [(next(ids), lp, v, inc) for _, lp, v, inc in got]


def sample(lattice: Lattice, text: str, key: int, k: int = K, seed: int = SEED) -> list[tuple]:
    """The samples of one text, ids as a list."""
    return [(ids.tolist(), *rest) for ids, *rest in next(sample_texts(lattice, [text], [key], k, seed))]


def sample_segmentations(docs: DataFrame, model: str = MODEL, k: int = K, seed: int = SEED) -> DataFrame:
    """k rows per row of ``docs``: doc_id, sample (0 first), n_pieces,
    log_prob, perturbed, inclusion, ids."""

    def run(batches):
        lattice = Lattice.of(model)
        for b in batches:
            _, offs = flat_bytes(b.column("text"))
            for lo, hi in chunks(offs, GRAPH_BYTES):
                keys = b.column("doc_id").slice(lo, hi - lo).to_pylist()
                texts = [t or "" for t in b.column("text").slice(lo, hi - lo).to_pylist()]
                rows = []
                got = sample_texts(lattice, texts, [-1 if d is None else d for d in keys], k, seed)
                for d, samples in zip(keys, got, strict=True):
                    rows += [(d, j, len(ids), lp, v, inc, ids) for j, (ids, lp, v, inc) in enumerate(samples)]
                yield out(rows)

    def out(rows):
        cols = list(zip(*rows, strict=True))
        offs = np.cumsum([0, *cols[2]]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(cols[6]).astype(np.int32)))
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols[:6], TYPES, strict=False)), ids], names=COLS)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def decode_segmentations(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, sample, text of sampled segmentations."""

    def run(batches):
        lattice = Lattice.of(model)
        for b in batches:
            texts = [lattice.decode(ids) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("sample"), pa.array(texts, pa.string())], names=["doc_id", "sample", "text"])

    return rows.select("doc_id", "sample", "ids").mapInArrow(run, "doc_id long, sample int, text string")
