"""The state box: border lines chained to one path and closed far out at sea and in the south. Small and fixed, so it is built on the driver."""

from __future__ import annotations

import numpy as np

from .geometry import Area

SOUTH, WEST = 31.0, -126.0
_PLACES = 4


class BoundaryError(ValueError):
    """Border lines that do not make one path."""


def chain(lines: list[np.ndarray]) -> np.ndarray:
    """The lines' vertices as one path from its western end; ends that agree to four decimals are joined."""
    steps = [(tuple(a), tuple(b)) for line in lines for a, b in zip(line[:-1].tolist(), line[1:].tolist())]
    if not steps:
        raise BoundaryError("no border lines")
    corner = lambda point: tuple(round(v, _PLACES) for v in point)
    meeting: dict[tuple, list[int]] = {}
    shown: dict[tuple, tuple] = {}
    for number, step in enumerate(steps):
        for end in step:
            meeting.setdefault(corner(end), []).append(number)
            shown.setdefault(corner(end), end)
    loose = [c for c, numbers in meeting.items() if len(numbers) % 2]
    if len(loose) != 2:
        raise BoundaryError(f"the border has {len(loose)} loose ends instead of two")
    here = min(loose, key=lambda c: c[0])
    path, walked = [shown[here]], set()
    while onward := [n for n in meeting[here] if n not in walked]:
        walked.add(onward[0])
        first, second = steps[onward[0]]
        path.append(second if corner(first) == here else first)
        here = corner(path[-1])
    return np.array(path)


def state_box(lines: list[np.ndarray]) -> Area:
    """The border, then due south, west, north and back: all of the state and nothing beyond the border."""
    path = chain(lines)
    corners = [(path[-1][0], SOUTH), (WEST, SOUTH), (WEST, path[0][1]), tuple(path[0])]
    return [[np.concatenate([path, np.array(corners)])]]
