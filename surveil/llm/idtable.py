"""Lists of token ids by string, in flat arrays."""

import numpy as np


class IdTable:
    """Strings with their ids; ``number`` is the place of a string in ``arrays``."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self._flat, self._lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def add(self, keys: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        """New strings with their ids one after the other."""
        base = len(self.number)
        self.number.update(zip(keys, range(base, base + len(keys))))
        self._flat.append(flat)
        self._lengths.append(lengths)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all ids, start of each string's, number of each string's)."""
        if len(self._flat) > 1:
            self._flat, self._lengths = [np.concatenate(self._flat)], [np.concatenate(self._lengths)]
        lengths = self._lengths[0]
        return self._flat[0], np.cumsum(lengths) - lengths, lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of all given stretches, one after the other."""
    total = np.cumsum(lengths)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)
