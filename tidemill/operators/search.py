"""Search of mixed parameter spaces by a Parzen density ratio.

Past trials are split at a quantile of their scores; each parameter's good and bad values make
two Parzen mixtures over its transformed range, and of some candidates drawn from the good one
the candidate with the largest ratio of densities is tried next.  Trials that still run count
as bad ones, so several can be asked for before any result is told.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping

# kind, low, high; kind: int | float | log (a float drawn on a logarithmic scale)
Space = Mapping[str, tuple[str, float, float]]

STARTUP = 10          # random trials before the densities are used
CANDIDATES = 24
GOOD_SHARE = 0.25


class ParzenSearch:
    """``ask()`` proposes parameters, ``tell()`` takes their score (lower is better, inf: failed)."""

    def __init__(self, space: Space, seed: int | str = 0, startup: int = STARTUP):
        for name, (kind, lo, hi) in space.items():
            if kind not in ("int", "float", "log") or lo > hi or (kind == "log" and lo <= 0):
                raise ValueError(f"bad dimension {name}: {(kind, lo, hi)}")
        self.space, self.startup = dict(space), startup
        self.rng = random.Random(str(seed))
        self.trials: list[tuple[dict, float | None]] = []      # None: still running

    def ask(self) -> tuple[int, dict]:
        """(trial number, parameters)."""
        told = [(p, s) for p, s in self.trials if s is not None]
        if len(told) < self.startup:
            params = {k: self._value(k, self.rng.uniform(*self._range(k))) for k in self.space}
        else:
            told.sort(key=lambda t: t[1])
            n_good = max(1, math.ceil(GOOD_SHARE * len(told)))
            good = [p for p, _ in told[:n_good]]
            bad = [p for p, _ in told[n_good:]] + [p for p, s in self.trials if s is None]
            params = {k: self._propose(k, [p[k] for p in good], [p[k] for p in bad]) for k in self.space}
        self.trials.append((params, None))
        return len(self.trials) - 1, params

    def tell(self, trial: int, score: float) -> None:
        self.trials[trial] = (self.trials[trial][0], math.inf if score is None or math.isnan(score) else score)

    def best(self) -> tuple[dict, float] | None:
        """The best finished trial; None if none gave a finite score."""
        done = [t for t in self.trials if t[1] is not None and t[1] < math.inf]
        return min(done, key=lambda t: t[1]) if done else None

    # a parameter's range on the scale it is drawn on; whole numbers own half a unit either side
    def _range(self, k: str) -> tuple[float, float]:
        kind, lo, hi = self.space[k]
        return (math.log(lo), math.log(hi)) if kind == "log" else (lo - 0.5, hi + 0.5) if kind == "int" else (lo, hi)

    def _value(self, k: str, x: float):
        kind, lo, hi = self.space[k]
        if kind == "int":
            return int(min(max(round(x), lo), hi))
        return min(max(math.exp(x) if kind == "log" else x, lo), hi)

    def _propose(self, k: str, good: list, bad: list):
        lo, hi = self._range(k)
        if hi <= lo:
            return self._value(k, lo)
        scale = math.log if self.space[k][0] == "log" else float
        g, b = (_Mixture([scale(v) for v in vs], lo, hi) for vs in (good, bad))
        drawn = [g.draw(self.rng) for _ in range(CANDIDATES)]
        return self._value(k, max(drawn, key=lambda x: g.log_density(x) - b.log_density(x)))


class _Mixture:
    """Normal kernels cut to [lo, hi], one at each value and a wide one for the whole range; a kernel
    is as wide as the larger gap to its neighbours, within bounds."""

    def __init__(self, values: list[float], lo: float, hi: float):
        self.lo, self.hi = lo, hi
        at = sorted([*values, (lo + hi) / 2])
        ends = [lo, *at, hi]
        least = (hi - lo) / min(100, len(at) + 1)
        self.kernels = [(m, min(hi - lo, max(least, m - a, z - m))) for a, m, z in zip(ends, at, ends[2:])]
        wide = at.index((lo + hi) / 2)
        self.kernels[wide] = ((lo + hi) / 2, hi - lo)
        self.mass = [_below((hi - m) / s) - _below((lo - m) / s) for m, s in self.kernels]

    def draw(self, rng: random.Random) -> float:
        m, s = rng.choice(self.kernels)
        while True:
            x = rng.gauss(m, s)
            if self.lo <= x <= self.hi:
                return x

    def log_density(self, x: float) -> float:
        return math.log(sum(math.exp(-0.5 * ((x - m) / s) ** 2) / (s * w) for (m, s), w in zip(self.kernels, self.mass))
                        / len(self.kernels) + 1e-300)


def _below(z: float) -> float:
    return 0.5 * (1 + math.erf(z / math.sqrt(2)))
