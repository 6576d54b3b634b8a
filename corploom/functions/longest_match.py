"""Greedy longest-match tokenization of Arrow batches, used inside Arrow UDFs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from corploom.functions.packed_ids import id_blocks, sums_at

_END = 256  # stands between texts, as a byte that no entry has
_SPAN = _END + 1
# Marks in place of ids: no token begins here, a text ends here, no entry begins here.
_NONE, _TEXT_END, _BAD = -1, -2, -3
_WINDOW = 4 << 20  # bytes matched at a time
_BLOCK = 512  # bytes of a lane at most
_SPARSE = 16  # beyond one place in so many, lanes are faster
_ROUNDS = 3  # in which blocks are walked again all at once


def _bytes_and_offsets(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of a string or binary array, and the row boundaries within them."""
    values = values.cast(pa.large_binary())
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Trie:
    """Byte strings as a trie in flat arrays: the child of `node` by byte `b` is `base[node] + b`
    if `check` there says `node`. `best_id` and `best_size` are those of the longest entry on
    the way to a node. `pair` has the node to start from for every two bytes, and `pair_depth` how
    many of them lead to it."""

    def __init__(self, ids: dict[bytes, int]):
        parent, byte, depth, value = self._nodes(ids)
        count = len(parent)
        node_base, slots, size = self._place(parent, byte)
        self.base = np.full(size, size - _SPAN, np.int64)  # nothing is there: a dead end
        self.check = np.full(size, -1, np.int64)
        self.best_id = np.full(size, _BAD, np.int32)
        self.best_size = np.ones(size, np.int64)
        self.base[slots] = node_base
        self.check[slots[1:]] = slots[parent[1:]]
        best, best_size = value.copy(), np.where(value >= 0, depth, 1)
        for level in range(1, int(depth.max()) + 1):
            nodes = np.flatnonzero((depth == level) & (value < 0) & (value != _TEXT_END))
            best[nodes], best_size[nodes] = best[parent[nodes]], best_size[parent[nodes]]
        self.best_id[slots], self.best_size[slots] = best, best_size
        dead = size - _SPAN - 1
        first = self._children(np.zeros(_SPAN, np.int32), np.arange(_SPAN))
        one, two = np.repeat(first, _SPAN), np.tile(np.arange(_SPAN), _SPAN)
        second = np.where(one >= 0, self._children(np.maximum(one, 0), two), -1)
        self.pair = np.where(second >= 0, second, np.where(one >= 0, one, dead)).astype(np.int64)
        self.pair_depth = np.where(second >= 0, 2, 1).astype(np.int64)
        self.longest = max(map(len, ids), default=0)
        self.slots = count

    def _children(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        child = self.base[node] + byte
        return np.where(self.check[child] == node, child, -1)

    @staticmethod
    def _nodes(ids: dict[bytes, int]):
        """Parent, byte, depth and id (or _BAD) of each node, breadth last; the root is 0 and the
        end of a text its first child."""
        parent, byte, depth, value = [-1, 0], [0, _END], [0, 1], [_BAD, _TEXT_END]
        path, before = [0], b""
        for token in sorted(ids):
            shared = 0
            while shared < min(len(before), len(token)) and before[shared] == token[shared]:
                shared += 1
            del path[shared + 1 :]
            for d in range(shared, len(token)):
                parent.append(path[-1])
                byte.append(token[d])
                depth.append(d + 1)
                value.append(_BAD)
                path.append(len(parent) - 1)
            if token:
                value[path[-1]] = ids[token]
            before = token
        return tuple(np.array(x, np.int64) for x in (parent, byte, depth, value))

    @staticmethod
    def _place(parent: np.ndarray, byte: np.ndarray):
        """Each node's base, each node's place, and the size of the arrays. Nodes with many children
        go first, each to the next base at which all children's places are free; those with one
        child take the places that are left, all at once."""
        order = np.argsort(parent[1:], kind="stable") + 1
        children = np.bincount(parent[1:], minlength=len(parent))
        first = np.cumsum(children) - children
        size = 4 * len(parent) + 4 * _SPAN
        free = np.ones(size, bool)
        free[0] = False  # the root
        base, slots = np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64)
        many = np.flatnonzero(children > 1)
        at = 1
        for node in many[np.argsort(-children[many], kind="stable")].tolist():
            kids = order[first[node] : first[node] + children[node]]
            wanted = byte[kids]
            tries = 0
            while not free[at + wanted].all():
                at += 1
                tries += 1
                if at + _SPAN >= len(free):
                    free = np.concatenate([free, np.ones(size, bool)])
            free[at + wanted] = False
            base[node], slots[kids] = at, at + wanted
            if tries > 16:  # crowded: look further on
                at += 8
        single = np.flatnonzero(children == 1)
        kids = order[first[single]]
        left = _SPAN + np.flatnonzero(free[_SPAN:])
        while len(left) < len(single):
            free = np.concatenate([free, np.ones(size, bool)])
            left = _SPAN + np.flatnonzero(free[_SPAN:])
        slots[kids] = left[: len(single)]
        base[single] = slots[kids] - byte[kids]
        used = int(slots.max()) + 1 if len(slots) else 1
        size = used + 2 * _SPAN + 2
        base[children == 0] = size - _SPAN
        return base, slots, size


class LongestMatch:
    """Token ids of byte strings: at each place the longest vocabulary entry wins.

    Texts stand back to back and are walked by thousands of lanes at once, a step of all lanes per
    array operation. A lane begins with each text and after each `_BLOCK` bytes, whether a token
    begins there or not; greedy matches meet soon, so that the tokens of the lane before, carried on into the block,
    run into those found there. Where they do not, the block is walked again from its true entry.
    If few places begin an entry of two bytes or more, only those are walked, and single bytes
    fill the rest.
    """

    def __init__(self, ids: dict[bytes, int]):
        self.trie = Trie(ids)
        self.single = np.full(_SPAN, _BAD, np.int32)
        self.single[_END] = _TEXT_END
        for token, number in ids.items():
            if len(token) == 1:
                self.single[token[0]] = number
        depth = self.trie.pair_depth.reshape(_SPAN, _SPAN)
        self.several = (depth == 2).ravel()

    def match(self, text: bytes) -> np.ndarray:
        """Ids of the tokens of one text."""
        return self.ids_and_ends(pa.array([text], pa.large_binary()))[0]

    def __call__(self, texts: pa.Array) -> pa.Array:
        """list<int32> of token ids for each text; null stays null."""
        ids, ends = self.ids_and_ends(texts)
        mask = texts.is_null() if texts.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=mask)

    def ids_and_ends(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text starts and ends among them."""
        raw, starts = _bytes_and_offsets(texts)
        ids, ends, count = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], 0
        for found in self._windows(raw, starts):
            marks = np.flatnonzero(found == _TEXT_END)
            ids.append(np.delete(found, marks))
            ends.append(count + marks - np.arange(len(marks)))
            count += len(found) - len(marks)
        return np.concatenate(ids), np.concatenate(ends)

    def _windows(self, raw: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """Ids with a mark behind each text, window by window."""
        text, count = 0, len(starts) - 1
        while text < count:
            last = max(text + 1, int(np.searchsorted(starts, starts[text] + _WINDOW, side="right")) - 1)
            at, stop = int(starts[text]), int(starts[last])
            while stop - at > _WINDOW + self.trie.longest:  # one long text
                part = raw[at : at + _WINDOW + self.trie.longest].astype(np.int16)
                ids, size = self._walk(np.append(part, np.int16(_END)), _WINDOW)
                yield ids
                at += size
            edges = starts[text + 1 : last + 1] - at
            data = np.full(stop - at + last - text, _END, np.int16)
            inside = np.ones(len(data), bool)
            inside[edges + np.arange(last - text)] = False
            data[inside] = raw[at:stop]
            yield self._walk(data, len(data))[0]
            text = last

    def _walk(self, data: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
        """Ids of the tokens that begin before `limit`, the first at 0, and where they end."""
        pairs = np.full(len(data) + 1, _SPAN * _SPAN - 1, np.int32)
        pairs[:-1] = data
        pairs[:-1] *= _SPAN
        pairs[: len(data) - 1] += data[1:]
        pairs[len(data) - 1 : -1] += _END
        several = np.flatnonzero(self.several[pairs[:limit]])
        found, end = (
            self._by_places(data, pairs, several, limit)
            if len(several) * _SPARSE < limit
            else self._by_lanes(data, pairs, limit)
        )
        ids = found[found != _NONE]
        if (ids == _BAD).any():
            at = int(np.flatnonzero(found == _BAD)[0])
            rest = data[at : at + 16]
            text = rest[: int(np.argmax(rest == _END)) if (rest == _END).any() else 16].astype(np.uint8)
            raise ValueError(f"no vocabulary entry matches the text at {text.tobytes()!r}")
        return ids, end

    def _longest(self, data: np.ndarray, pairs: np.ndarray, places: np.ndarray):
        """Id and size of the longest entry at each of the places, a byte of all of them a step."""
        trie = self.trie
        node = trie.pair[pairs[places]]
        at = places + trie.pair_depth[pairs[places]]
        live = np.arange(len(places))
        walking = node
        while len(live):
            child = trie.base[walking] + data[np.minimum(at, len(data) - 1)]
            onward = (trie.check[child] == walking) & (at < len(data))
            live, walking, at = live[onward], child[onward], at[onward] + 1
            node[live] = walking
        return trie.best_id[node], trie.best_size[node]

    def _by_places(self, data: np.ndarray, pairs: np.ndarray, places: np.ndarray, limit: int):
        found = self.single[data[:limit]]
        ids, sizes = self._longest(data, pairs, places)
        several = sizes > 1
        places, ids, ends = places[several], ids[several], places[several] + sizes[several]
        if len(places) and (places[1:] < ends[:-1]).any():
            kept, free = [], 0
            for i, (place, end) in enumerate(zip(places.tolist(), ends.tolist())):
                if place >= free:
                    kept.append(i)
                    free = end
            places, ids, ends = places[kept], ids[kept], ends[kept]
        if len(places):
            covered = np.zeros(max(limit, int(ends[-1])) + 1, np.int8)
            covered[places] += 1
            covered[ends] -= 1
            found[np.cumsum(covered[:limit], dtype=np.int8) > 0] = _NONE
            found[places] = ids
        return found, max(limit, int(ends[-1]) if len(places) else 0)

    def _lanes(self, data, pairs, start, stop, visit) -> np.ndarray:
        """Walks from each `start` until a token ends at or after `stop`, or as far as `visit`
        lets it: it gets lanes, places and ids of the tokens of each step, and returns which lanes
        end there. The places at which the lanes ended."""
        trie, exits = self.trie, start.copy()
        lane = np.flatnonzero(start < stop)
        start, stop = start[lane], stop[lane]
        first = pairs[start]
        node, at = trie.pair[first], start + trie.pair_depth[first]
        while len(lane):
            child = trie.base[node]
            child += data[at]
            ended = np.flatnonzero(trie.check[child] != node)
            if not len(ended):
                node, at = child, at + 1
                continue
            last = node[ended]
            place = start[ended]
            done = visit(lane[ended], place, trie.best_id[last])
            place = np.where(done, place, place + trie.best_size[last])
            done |= place >= stop[ended]
            start[ended] = place
            first = pairs[place]
            node, at = child, at + 1
            node[ended] = trie.pair[first]
            at[ended] = place + trie.pair_depth[first]
            if done.any():
                exits[lane[ended[done]]] = place[done]
                going = np.ones(len(lane), bool)
                going[ended[done]] = False
                lane, start, stop, node, at = (x[going] for x in (lane, start, stop, node, at))
        return exits

    def _by_lanes(self, data: np.ndarray, pairs: np.ndarray, limit: int):
        begins = np.unique(np.concatenate([np.arange(0, limit, _BLOCK), np.flatnonzero(data[: limit - 1] == _END) + 1]))
        stops = np.append(begins[1:], limit)
        padded = np.concatenate([data, np.full(self.trie.longest + 2, _END, np.int16)])
        found = np.full(limit, _NONE, np.int32)

        def note(lanes, places, ids):
            found[places] = ids
            return np.zeros(len(lanes), bool)

        exits = self._lanes(padded, pairs, begins, stops, note)
        own = exits.copy()
        # From its true entry, a block is walked up to a token that its lane found: `meets`.
        entries, meets = begins.copy(), begins.copy()
        fixed: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rounds = 0
        while len(todo := np.flatnonzero(exits[:-1] != entries[1:]) + 1):
            if rounds == _ROUNDS:
                block = int(todo[0])
                places, ids, at = self._hops(data, pairs, found, int(exits[block - 1]), limit)
                last = int(np.searchsorted(begins, at, side="right")) - 1 if at < limit else len(begins) - 1
                for k in range(block, last + 1):
                    fixed.pop(k, None)
                fixed[block] = places, ids
                ends = np.append(places, at)
                passed = slice(block, last + 1)
                entries[passed] = ends[np.minimum(np.searchsorted(ends, begins[passed]), len(places))]
                meets[passed] = stops[passed]
                exits[passed] = ends[np.minimum(np.searchsorted(ends, stops[passed]), len(places))]
                if at < limit:
                    meets[last], exits[last] = at, own[last]
                continue
            rounds += 1
            entries[todo] = exits[todo - 1]
            steps: list = []

            def until_met(lanes, places, ids):
                met = found[places] != _NONE
                steps.append((lanes[~met], places[~met], ids[~met]))
                return met

            ends = self._lanes(padded, pairs, entries[todo], stops[todo], until_met)
            met = ends < stops[todo]
            meets[todo] = np.minimum(ends, stops[todo])
            exits[todo] = np.where(met, own[todo], ends)
            for block in todo.tolist():
                fixed.pop(block, None)
            fixed.update(self._by_block(todo, steps))
        # What the lanes found counts from `meets` on; before that, what the true entries gave.
        edge = np.zeros(limit + 1, np.int32)
        np.add.at(edge, begins, 1)
        np.add.at(edge, meets, -1)
        found[np.cumsum(edge[:-1]) > 0] = _NONE
        for places, ids in fixed.values():
            found[places] = ids
        return found, int(exits[-1])

    @staticmethod
    def _by_block(blocks: np.ndarray, steps: list) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        """Places and ids of each lane's steps, under the number of its block."""
        if not steps:
            return
        lanes, places, ids = (np.concatenate(x) for x in zip(*steps))
        order = np.argsort(lanes, kind="stable")
        lanes, places, ids = lanes[order], places[order], ids[order]
        cuts = np.flatnonzero(np.diff(lanes)) + 1
        for lane, p, i in zip(np.split(lanes, cuts), np.split(places, cuts), np.split(ids, cuts)):
            if len(lane):
                yield int(blocks[lane[0]]), (p, i)

    def _hops(self, data, pairs, found, at: int, limit: int):
        """Tokens from a true place on, up to one that a lane found. For stretches in which blocks
        do not meet, as in a run of one letter: the longest entries at all places at once, then a
        hop per token."""
        places, ids, size = [np.empty(0, np.int64)], [np.empty(0, np.int32)], _BLOCK
        while at < limit:
            stretch = np.arange(at, min(at + size, limit))
            longest, sizes = self._longest(data, pairs, stretch)
            steps, met = sizes.tolist(), (found[stretch] != _NONE).tolist()
            hops, here = [], 0
            while here < len(steps) and not met[here]:
                hops.append(here)
                here += steps[here]
            places.append(stretch[hops])
            ids.append(longest[hops])
            at += here
            if here < len(steps):
                break
            size = min(2 * size, _WINDOW)
        return np.concatenate(places), np.concatenate(ids), at


class TokenBytes:
    """The reverse: joined token bytes of id lists. An unknown id is an error."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        order = sorted(tokens)
        self.row_of = np.full(max(order, default=0) + 1, -1, np.int64)
        self.row_of[order] = np.arange(len(order))
        self.rows = pa.array([tokens[i] for i in order], pa.large_binary())
        self.row_sizes = np.array([len(tokens[i]) for i in order], np.int64)

    def __reduce__(self):
        return TokenBytes, (self.tokens,)

    def _taken(self, ids: np.ndarray, data: list) -> np.ndarray:
        """Sizes of the tokens of these ids, whose bytes go to `data`."""
        known = (ids >= 0) & (ids < len(self.row_of))
        rows = np.where(known, self.row_of[np.where(known, ids, 0)], -1)
        if (rows < 0).any():
            raise ValueError(f"token id {ids[rows < 0][0]} is not in the vocabulary")
        sizes = self.row_sizes[rows]
        data.append(memoryview(self.rows.take(pa.array(rows)).buffers()[2])[: int(sizes.sum())])
        return sizes

    def __call__(self, id_lists: pa.Array) -> pa.Array:
        offsets = np.asarray(id_lists.offsets)
        ids = np.asarray(id_lists.values)[offsets[0] : offsets[-1]]
        data: list = []
        ends = sums_at(offsets - offsets[0], (self._taken(block, data) for block in id_blocks(ids)))
        data = pa.py_buffer(b"".join(data))
        valid = None
        if id_lists.null_count:
            valid = id_lists.is_valid().buffers()[1]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(id_lists), [valid, pa.py_buffer(ends), data]
        )
