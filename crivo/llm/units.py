"""Token ids of whole columns, worked out once for each distinct unit.

A unit is a stretch of text whose ids do not depend on what stands around it.
Most units of a batch are frequent ones, so a batch is split and its units
numbered by Arrow, distinct units are encoded, and ids are gathered by number.
"""

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Units remembered between batches. What is forgotten is encoded again.
MOST_REMEMBERED = 400_000


class UnitEncoder:
    """``encode`` gives ids of many units, end to end, and how many each has;
    ``whole`` those of a text whose blanks do not separate units, as ``odd`` finds."""

    def __init__(
        self,
        encode: Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]],
        whole: Callable[[str], Sequence[int]],
        odd: str,
        first_blank: bool,
    ):
        self.encode, self.whole, self.odd, self.first_blank = encode, whole, odd, first_blank
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.n_ids = np.empty(1 << 16, np.int32), 0
        self.starts, self.sizes = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _numbers(self, units: list[str]) -> np.ndarray:
        """Where each unit's ids are remembered."""
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > MOST_REMEMBERED:
            self._forget()
            new = units
        if new:
            ids, sizes = self.encode(new)
            count = len(self.known)
            self.ids = _with_room(self.ids, self.n_ids, len(ids))
            self.starts, self.sizes = (_with_room(a, count, len(new)) for a in (self.starts, self.sizes))
            self.ids[self.n_ids : self.n_ids + len(ids)] = ids
            self.sizes[count : count + len(new)] = sizes
            self.starts[count : count + len(new)] = self.n_ids + np.cumsum(sizes) - sizes
            self.n_ids += len(ids)
            self.known.update(zip(new, range(count, count + len(new))))
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the n+1 offsets of rows in them; null is empty."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd & ~empty)
        sizes, parts = np.zeros(len(texts), np.int64), {}
        for row in np.flatnonzero(odd):
            parts[row] = np.array(self.whole(texts[int(row)].as_py()), np.int32)
            sizes[row] = len(parts[row])
        ids = np.empty(0, np.int32)
        if len(plain):
            lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
            numbered = lists.flatten().dictionary_encode()
            starts = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
            codes = numbered.indices.to_numpy().astype(np.int64) * 2 + 1
            if not self.first_blank:
                codes[starts] -= 1
            names = numbered.dictionary.to_pylist()
            used = np.zeros(2 * len(names), bool)
            used[codes] = True
            place, used = np.cumsum(used) - 1, np.flatnonzero(used)
            found = self._numbers([(" " if c & 1 else "") + names[c >> 1] for c in used.tolist()])
            codes = found[place[codes]]
            width = self.sizes
            ids = gather(self.ids, self.starts, width, codes)
            sizes[plain] = np.add.reduceat(width[codes], starts)
        offsets = np.r_[0, np.cumsum(sizes)]
        if parts:
            out = np.empty(int(offsets[-1]), np.int32)
            mine = np.ones(len(out), bool)
            for row, found in parts.items():
                out[offsets[row] : offsets[row + 1]] = found
                mine[offsets[row] : offsets[row + 1]] = False
            out[mine] = ids
            ids = out
        return ids, offsets


def _with_room(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or a longer copy of it that has room for more."""
    if used + more <= len(values):
        return values
    longer = np.empty(max(2 * len(values), used + more), values.dtype)
    longer[:used] = values[:used]
    return longer


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Stretches of ``values``, one for each code, end to end."""
    size = sizes[codes]
    shift = starts[codes] - (np.cumsum(size) - size)
    return values[np.arange(int(size.sum())) + np.repeat(shift, size)]
