"""Operator 7: sampled SentencePiece segmentations without replacement, and their decoding.

All ways to cut a text into vocabulary pieces form a lattice. The model file holds a BPE
vocabulary, whose scores are merge ranks and no probabilities; a piece of rank r weighs
1 / (r + 2), a character outside the vocabulary is its byte pieces, and a path's probability is
proportional to the product of its pieces' weights. Backward sums over the lattice turn this into
probabilities of single steps.

Sampling is a perturbed A-star search from the start of the text. Every path has its log
probability plus Gumbel noise; a search node (a beginning of paths) has the largest value among
its paths. The best node's value stays with one child, drawn by its share; the others get Gumbel
values cut at it. So a node is followed to the text's end at once (one sample), its siblings go to
the queue, and the best of the queue is next. The k paths found are a sample without replacement;
the best value left in the queue is the threshold of their inclusion probabilities.

No piece reaches over a word's beginning, so words are lattices of their own: a batch builds each
distinct word's lattice once, and draws for all words step by step together. Siblings are made
where they can still win: noise adds at most REACH to a log probability, so once the k-th best is
beyond that, later ones cannot. Noise is a hash of the row key, sample, place and edge: the same
for a row wherever it is processed.

Contract: null text counts as empty; its one path has no pieces (log probability 0). Texts with
fewer than k paths give all of them, each with inclusion probability 1. A null row key is 0.
Repeated rows give the same samples again. Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.tables import slices, worker_cache
from tallyward.llm.word_hashes import BASE, mix, stretches

BLANK = "▁"
SAMPLES = 3
REACH = 22.9  # the most that noise of 32 bits can add: -log(-log(1 - 2 ** -33))


class Vocabulary:
    """Pieces as a trie in sorted arrays, and as bytes for decoding."""

    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.byte_id = np.zeros(256, np.int64)
        weight = np.zeros(size)
        written = [b""] * size
        children: dict[tuple[int, int], int] = {}
        piece_at: list[int] = [-1]
        for i in range(size):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(text[3:5], 16)] = i
                written[i] = bytes([int(text[3:5], 16)])
                weight[i] = -np.log(size + 2.0)
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            written[i] = text.replace(BLANK, " ").encode()
            weight[i] = -np.log(min(-sp.get_score(i), size) + 2.0)
            node = 0
            for ch in text:
                key = node, ord(ch)
                if key not in children:
                    children[key] = len(piece_at)
                    piece_at.append(-1)
                node = children[key]
            piece_at[node] = i
        self.weight = weight
        keys = np.array([n << 21 | c for n, c in children], np.int64)
        nodes = np.array(list(children.values()), np.int64)
        self.piece_at = np.array(piece_at, np.int64)
        self.roots = np.full(0x110000, -1, np.int32)  # the first step of the walk, for all characters
        of_root = keys < 1 << 21
        self.roots[keys[of_root]] = nodes[of_root]
        # All other steps: a table by hash, -1 where free; what finds its slot taken goes to the next one.
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.nodes = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        todo, slot = np.arange(len(keys)), self.slot(keys)
        while len(todo):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] < 0]
            self.keys[slot[first]], self.nodes[slot[first]] = keys[todo[first]], nodes[todo[first]]
            rest = np.delete(np.arange(len(todo)), first)
            todo, slot = todo[rest], (slot[rest] + 1) & self.mask
        self.longest = max(len(sp.id_to_piece(i)) for i in range(size) if not sp.is_byte(i))
        self.flat = np.frombuffer(b"".join(written), np.uint8)
        self.sizes = np.array([len(w) for w in written], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(BASE)) >> self.shift).view(np.int64)

    def child(self, node: np.ndarray, point: np.ndarray) -> np.ndarray:
        """-1 where there is none."""
        key = node << 21 | point
        slot = self.slot(key)
        held, found = self.keys.take(slot), self.nodes.take(slot)
        far = np.flatnonzero((held != key) & (held >= 0))
        found[far] = -1
        while len(far):
            slot[far] = own = (slot[far] + 1) & self.mask
            held = self.keys[own]
            hit = held == key[far]
            found[far[hit]] = self.nodes[own[hit]]
            far = far[~hit & (held >= 0)]
        return found

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The texts' bytes, with the blank that stands before every text, and the bytes of each."""
        size = self.sizes.take(ids)
        upto = np.concatenate([[0], np.cumsum(size)])
        step = np.repeat(self.begins.take(ids) - upto[:-1], size)
        step += np.arange(len(step))
        return self.flat.take(step).tobytes(), np.diff(upto[np.concatenate([[0], np.cumsum(counts)])])


class Lattice:
    """Edges of all places of some words: piece (-1: the bytes of a character), end, log
    probability of the step, and its cumulated probability among its place's edges."""

    def __init__(self, vocabulary: Vocabulary, points: np.ndarray, sizes: np.ndarray):
        n = len(points)
        ends = np.cumsum(sizes)
        stop = np.repeat(ends, sizes)
        place, node = np.arange(n), np.zeros(n, np.int64)
        starts, pieces, lengths = [], [], []
        for length in range(1, vocabulary.longest + 1):
            live = place + length <= stop.take(place)
            if not live.all():
                place, node = place[live], node[live]
            point = points.take(place + (length - 1))
            node = vocabulary.child(node, point) if length > 1 else vocabulary.roots.take(point).astype(np.int64)
            known = np.flatnonzero(node >= 0)
            place, node = place.take(known), node.take(known)
            if not len(place):
                break
            found = vocabulary.piece_at.take(node)
            real = np.flatnonzero(found >= 0)
            starts.append(place.take(real))
            pieces.append(found.take(real))
            lengths.append(length)
        single = np.zeros(n, bool)
        single[starts[0] if starts else []] = True
        missing = np.flatnonzero(~single)  # characters that are no piece
        starts.append(missing)
        pieces.append(np.full(len(missing), -1))
        lengths.append(1)
        # Edges stand by their place's distance to the word's end, the order of the backward sums.
        # A place has one edge of each length at most, so each length is dealt out at once.
        left = stop - np.arange(n)
        short = n == 0 or left.max() < 1 << 16
        places = np.argsort(left.astype(np.uint16 if short else np.int64), kind="stable")
        self.degree = np.zeros(n, np.int64)
        for group in starts:
            self.degree[group] += 1
        degree = self.degree.take(places)
        first = np.cumsum(degree) - degree
        self.first = np.empty(n, np.int64)
        self.first[places] = first
        free, size = self.first.copy(), int(degree.sum())
        piece, length = np.empty(size, np.int64), np.empty(size, np.int64)
        for group, own, long in zip(starts, pieces, lengths):
            at = free.take(group)
            piece[at], length[at] = own, long
            free[group] = at + 1
        self.start = np.repeat(places, degree)
        self.end = self.start + length
        self.piece = piece
        distance = left.take(places)
        # What follows an edge: the place it ends at, or n, which adds nothing, at the word's end.
        follows = np.where(np.repeat(distance, degree) == length, n, self.end)
        weight = vocabulary.weight.take(piece)
        bare = np.flatnonzero(piece < 0)
        point = points[self.start[bare]]
        wide = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
        weight[bare] = wide * vocabulary.weight[vocabulary.byte_id[0]]
        sums = np.zeros(n + 1)
        bounds = np.searchsorted(distance, np.arange(1, (distance[-1] if n else 0) + 2))
        self.log = np.empty(size)
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            e = slice(first[a], first[b] if b < len(first) else size)
            value = weight[e] + sums.take(follows[e])
            at, many = first[a:b] - first[a], degree[a:b]
            top = np.maximum.reduceat(value, at)
            total = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, many)), at))
            sums[places[a:b]] = total
            np.subtract(value, np.repeat(total, many), out=self.log[e])
        step = np.exp(self.log)
        share = np.cumsum(step)
        before = share.take(first) - step.take(first)
        share -= np.repeat(before, degree)
        share[first + degree - 1] = 2.0  # the last edge takes what rounding leaves
        self.share = share


def blend(x: np.ndarray, *parts) -> np.ndarray:
    """Goes on with a hash, part by part."""
    with np.errstate(over="ignore"):
        for part in parts:
            x = mix((x ^ np.asarray(part).astype(np.uint64)) * np.uint64(BASE) + np.uint64(1))
    return x


def fraction(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) of the upper 32 bits of a hash."""
    return ((x >> np.uint64(32)).astype(np.float64) + 0.5) / 2.0 ** 32


def uniform(*parts) -> np.ndarray:
    """Numbers in (0, 1) of 32 bits from a hash of the parts."""
    return fraction(blend(np.uint64(0), *parts))


class Batch:
    """Texts as words, each an occurrence of a distinct word with a lattice."""

    def __init__(self, vocabulary: Vocabulary, texts: list[str], keys: np.ndarray):
        self.vocabulary, self.keys = vocabulary, keys
        normal = [(BLANK + t.replace(" ", BLANK)) if t else "" for t in texts]
        points = np.frombuffer("".join(normal).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.sizes = np.fromiter(map(len, normal), np.int64, len(normal))
        blank = points == ord(BLANK)
        first = np.zeros(len(points) + 1, bool)
        first[np.cumsum(self.sizes) - self.sizes] = True
        begin = np.flatnonzero(first[:-1] | (blank & ~np.concatenate([[True], blank[:-1]])) if len(points) else first[:-1])
        size = np.diff(np.append(begin, len(points)))
        self.text_of = np.searchsorted(np.cumsum(self.sizes), begin, "right")
        self.place = begin - (np.cumsum(self.sizes) - self.sizes)[self.text_of]
        key = stretches(points.astype(np.uint32).view(np.uint8), 4 * begin, 4 * size)
        self.order = np.argsort(key, kind="stable")  # occurrences, those of a word together
        key = key.take(self.order)
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        at = self.order[new]
        self.word = np.empty(len(key), np.int64)
        self.word[self.order] = np.cumsum(new) - 1
        own = size[at]
        self.base = np.cumsum(own) - own  # first place of each distinct word in the lattice
        self.own = own
        step = np.arange(own.sum()) + np.repeat(begin[at] - self.base, own)
        self.points = points[step]
        self.lattice = Lattice(vocabulary, self.points, own)

    def paths(self, text: np.ndarray, word: np.ndarray, inside: np.ndarray, sample: int):
        """One path through each word occurrence ``word`` from place ``inside`` of it on: word
        index and edge of every step, in order."""
        lattice = self.lattice
        # Lanes of the same word go together, so that neighbours read the same part of the lattice.
        lane = np.full(len(self.word), -1)
        lane[word] = np.arange(len(word))
        lane = lane.take(self.order)
        lane = lane[lane >= 0]
        own = word.take(lane)
        kind = self.word.take(own)
        base = self.base.take(kind)
        at, stop = base + inside.take(lane), base + self.own.take(kind)
        # What the lanes still under way need: hash of key and sample, end of the word, place less ``at``.
        ahead = self.place.take(own) - base
        seed = blend(np.uint64(0), self.keys, sample).take(text.take(lane))
        lanes, edges, steps = [], [], np.zeros(len(word), np.int64)
        while len(lane):
            u = fraction(blend(seed, ahead + at, 7))
            edge = lattice.first.take(at)
            late = np.flatnonzero(u > lattice.share.take(edge))
            while len(late):
                next_ = edge.take(late) + 1
                edge[late] = next_
                late = late[u.take(late) > lattice.share.take(next_)]
            lanes.append(lane)
            edges.append(edge)
            steps[lane] = len(lanes)
            at = lattice.end.take(edge)
            live = np.flatnonzero(at < stop)
            lane, at, stop, ahead, seed = (x.take(live) for x in (lane, at, stop, ahead, seed))
        first = np.cumsum(steps) - steps
        out = np.empty(int(steps.sum()), np.int64)
        for i, (lane, edge) in enumerate(zip(lanes, edges)):
            out[first.take(lane) + i] = edge
        return np.repeat(np.arange(len(word)), steps), out

    def sample(self, k: int) -> list[dict]:
        """Rounds of samples: arrays text, sample, ids, counts, log, value; then thresholds."""
        texts, lattice = len(self.sizes), self.lattice
        words_upto = np.searchsorted(self.text_of, np.arange(texts + 1))
        queue: list[list[tuple]] = [[] for _ in range(texts)]
        root = -np.log(-np.log(uniform(self.keys, 0, 0, 1)))
        # A node: value, log probability, first word, place within it, edges before it.
        nodes = {t: (root[t], 0.0, words_upto[t], 0, np.empty(0, np.int64)) for t in range(texts)}
        out = []
        for sample in range(k):
            if not nodes:
                break
            text = np.fromiter(nodes, np.int64, len(nodes))
            value = np.array([nodes[t][0] for t in text])
            prefix = np.array([nodes[t][1] for t in text])
            begin = np.array([nodes[t][2] for t in text], np.int64)
            many = words_upto[text + 1] - begin
            owner = np.repeat(np.arange(len(text)), many)
            word = np.arange(many.sum()) + np.repeat(begin - (np.cumsum(many) - many), many)
            inside = np.zeros(len(word), np.int64)
            head = (np.cumsum(many) - many)[many > 0]
            inside[head] = np.array([nodes[t][3] for t in text], np.int64)[many > 0]
            lane, edge = self.paths(text.take(owner), word, inside, sample)
            whose = owner.take(lane)
            steps = np.bincount(whose, minlength=len(text))
            first = np.cumsum(steps) - steps
            gain = lattice.log.take(edge)
            total = np.cumsum(gain)
            start = np.concatenate([[0.0], total])[first]
            before = total - gain - start.take(whose) + prefix.take(whose)
            reached = prefix + np.bincount(whose, gain, len(text))
            ahead = [nodes[t][4] for t in text]
            self._siblings(queue, k - sample, sample, text, value, whose, before, first, steps,
                           (ahead, edge, first, word, lane))
            sizes = np.array([len(a) for a in ahead]) + steps
            parts = [x for i, a in enumerate(ahead) for x in (a, edge[first[i]:first[i] + steps[i]])]
            out.append({"text": text, "sample": sample, "edges": np.concatenate(parts) if parts else edge,
                        "counts": sizes, "log": reached, "value": value})
            nodes = {}
            for t in range(texts):
                if queue[t] and (sample == 0 or t in set_of(out[-1])):
                    nodes[t] = self._node(*queue[t].pop(0))
        self.threshold = np.full(texts, -np.inf)
        for t, node in nodes.items():
            self.threshold[t] = node[0]
        return out

    def _siblings(self, queue, wanted, sample, text, value, whose, before, first, steps, found):
        """Adds to each text's queue the siblings along its path that may be among the best."""
        lattice, (_, edge, _, word, lane) = self.lattice, found
        floor = np.full(len(text), -REACH - 4)
        todo = np.arange(len(text))
        while len(todo):
            chosen = np.zeros(len(text), bool)
            chosen[todo] = True
            at = np.flatnonzero(before >= np.where(chosen, floor, np.inf).take(whose))
            taken = edge.take(at)
            start, own = self._place_of(taken), word.take(lane.take(at))
            degree = lattice.degree.take(start)
            place = self.place.take(own) + start - self.base.take(self.word.take(own))
            seed = blend(blend(np.uint64(0), self.keys[text], sample).take(whose.take(at)), place, 11)
            of = np.repeat(np.arange(len(at)), degree)
            other = np.arange(len(of)) + np.repeat(lattice.first.take(start) - (np.cumsum(degree) - degree), degree)
            else_ = np.flatnonzero(other != taken.take(of))
            of, other = of.take(else_), other.take(else_)
            step = at.take(of)
            log = before.take(step) + lattice.log.take(other)
            mine = whose.take(step)
            noise = -np.log(fraction(blend(seed.take(of), lattice.end.take(other) - start.take(of), lattice.piece.take(other) + 1)))
            cut = log - np.log(np.exp(np.minimum(log - value[mine], 700)) + noise)
            order = _best(cut, mine, len(text), wanted)
            order = order[np.lexsort((-cut[order], mine[order]))]
            bound = np.searchsorted(mine[order], np.arange(len(text) + 1))
            order = order[np.arange(len(order)) - bound[mine[order]] < wanted]
            bound = np.searchsorted(mine[order], np.arange(len(text) + 1)).tolist()
            # What a node is made of, should it come up: value, log probability, its text's place
            # among these, step, edge.
            made = list(zip(cut[order].tolist(), log[order].tolist(), mine[order].tolist(),
                            step[order].tolist(), other[order].tolist()))
            again = []
            for i in todo.tolist():
                t = int(text[i])
                held = sorted([*queue[t], *((*x, found) for x in made[bound[i]:bound[i + 1]])], key=lambda x: -x[0])[:wanted]
                deeper = steps[i] and before[first[i] + steps[i] - 1] < floor[i]
                if deeper and (len(held) < wanted or held[-1][0] <= floor[i] + REACH):
                    floor[i] *= 8
                    again.append(i)
                else:
                    queue[t] = held
            todo = np.array(again, np.int64)

    def _node(self, value, log, i, step, other, found) -> tuple:
        """Value, log probability, first word, place within it, and the edges before it."""
        ahead, edge, first, word, lane = found
        own = word[lane[step]]
        inside = self.lattice.end[other] - self.base[self.word[own]]
        edges = np.concatenate([ahead[i], edge[first[i]:step], [other]])
        if inside == self.own[self.word[own]]:
            return value, log, own + 1, 0, edges
        return value, log, own, inside, edges

    def _place_of(self, edge: np.ndarray) -> np.ndarray:
        return self.lattice.start.take(edge)

    def ids(self, edges: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids; a character without a piece becomes its bytes."""
        found = self.lattice.piece.take(edges)
        if not len(found) or found.min() >= 0:
            return found, counts
        missing = np.flatnonzero(found < 0)
        points = self.points[self._place_of(edges[missing])]
        sizes = np.ones(len(found), np.int64)
        raw = {c: chr(c).encode("utf-8", "surrogatepass") for c in np.unique(points).tolist()}
        for c, own in raw.items():
            sizes[missing[points == c]] = len(own)
        total = np.cumsum(sizes)
        out = np.repeat(found, sizes)
        for c, own in raw.items():
            first = (total - sizes)[missing[points == c]]
            for j, byte in enumerate(own):
                out[first + j] = self.vocabulary.byte_id[byte]
        upto = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(counts)])]
        return out, np.diff(upto)


def _best(value: np.ndarray, group: np.ndarray, groups: int, wanted: int) -> np.ndarray:
    """Indices among which the ``wanted`` largest values of each group are; ``group`` ascends. Of as many
    parts of a group, each has a value that is not less than the least of the parts' largest."""
    upto = np.searchsorted(group, np.arange(groups + 1))
    many = np.diff(upto)
    large = np.flatnonzero(many >= wanted)
    if not len(large):
        return np.arange(len(value))
    part = upto[large, None] + many[large, None] * np.arange(wanted) // wanted
    ends = np.column_stack([part, upto[large + 1]]).ravel()
    tops = np.maximum.reduceat(np.append(value, -np.inf), ends).reshape(-1, wanted + 1)[:, :wanted]
    least = np.full(groups, -np.inf)
    least[large] = tops.min(1)
    return np.flatnonzero(value >= least.take(group))


def set_of(found: dict) -> set:
    if "set" not in found:
        found["set"] = set(found["text"].tolist())
    return found["set"]


def vocabulary(path: str) -> Vocabulary:
    made = worker_cache("vocabulary")
    if path not in made:
        made[path] = Vocabulary(path)
    return made[path]


def segmentations(texts: list[str], keys: np.ndarray, own: Vocabulary, k: int = SAMPLES) -> Iterator[dict]:
    """Samples of each text: text (index), sample, ids, log_prob, perturbed, log_inclusion, decoded."""
    batch = Batch(own, texts, keys)
    rounds = batch.sample(k)
    for found in rounds:
        ids, counts = batch.ids(found["edges"], found["counts"])
        data, sizes = own.decode(ids, counts)
        ends, tops = np.cumsum(counts), np.cumsum(sizes)
        for i, t in enumerate(found["text"].tolist()):
            gap = found["log"][i] - batch.threshold[t]
            with np.errstate(over="ignore"):
                inclusion = np.log(-np.expm1(-np.exp(gap))) if gap > -30 else gap
            yield {"text": t, "sample": found["sample"], "ids": ids[ends[i] - counts[i]:ends[i]],
                   "log_prob": found["log"][i], "perturbed": found["value"][i], "log_inclusion": float(inclusion),
                   "decoded": data[tops[i] - sizes[i]:tops[i]][1:]}


def sample_table(docs: DataFrame, path: str, k: int = SAMPLES, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """A row for each sample: the key, sample, n_pieces, ids_crc32, log_prob, perturbed,
    log_inclusion, decodes (its pieces spell the text), and the ids when asked for."""
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce("text", F.lit("")).alias("text"))
    ddl = f"{key} long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, decodes boolean"
    names = [key, "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "decodes"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
    if with_ids:
        ddl, names, kinds = ddl + ", ids array<int>", [*names, "ids"], [*kinds, pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(texts, 4_000_000):
                seeds = np.array([x or 0 for x in keys[a:b]], np.int64)
                made: list[list] = [[] for _ in names]
                for s in segmentations(texts[a:b], seeds, own, k):
                    text = texts[a + s["text"]]
                    row = [keys[a + s["text"]], s["sample"], len(s["ids"]), zlib.crc32(s["ids"].astype("<u4").tobytes()),
                           s["log_prob"], s["perturbed"], s["log_inclusion"],
                           s["decoded"] == text.replace(BLANK, " ").encode("utf-8", "surrogatepass")]
                    for column, v in zip(made, [*row, s["ids"].tolist()] if with_ids else row):
                        column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(made, kinds)], names=names)

    return rows.mapInArrow(run, ddl)
