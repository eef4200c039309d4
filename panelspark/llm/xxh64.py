"""XXH64 of many stretches of one buffer at once (the public XXH64 specification, in numpy)."""

from __future__ import annotations

import numpy as np

U = np.uint64
# Fixed values of the specification.
P1, P2, P3, P4, P5 = (
    U(0x9E3779B185EBCA87),
    U(0xC2B2AE3D27D4EB4F),
    U(0x165667B19E3779F9),
    U(0x85EBCA77C2B2AE63),
    U(0x27D4EB2F165667C5),
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << U(by)) | (x >> U(64 - by))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """One unsigned hash for each stretch ``data[start:end]``."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    four = np.ndarray(len(data) + 1, "<u4", padded, strides=(1,))
    s, size, at = U(seed), (end - start).astype(np.int64), start.astype(np.int64).copy()
    with np.errstate(over="ignore"):
        h = np.full(len(at), s + P5, U)
        long = np.flatnonzero(size >= 32)
        if len(long):
            acc = [np.full(len(long), v, U) for v in (s + P1 + P2, s + P2, s, s - P1)]
            active, p = np.arange(len(long)), at[long]
            stripes = size[long] // 32
            done = 0
            while len(active):
                for lane in range(4):
                    acc[lane][active] = _round(acc[lane][active], eight[p[active] + 8 * lane])
                p[active] += 32
                done += 1
                active = active[stripes[active] > done]
            total = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for a in acc:
                total = (total ^ _round(np.zeros(len(a), U), a)) * P1 + P4
            h[long], at[long] = total, p
        h += size.astype(U)
        rest = end - at
        for k in range(3):  # at most three lanes of eight bytes are left
            now = np.flatnonzero(rest >= 8 * (k + 1))
            if not len(now):
                break
            lane = eight[at[now]]
            h[now] = _turn(h[now] ^ _round(np.zeros(len(now), U), lane), 27) * P1 + P4
            at[now] += 8
        now = np.flatnonzero(end - at >= 4)
        h[now] = _turn(h[now] ^ (four[at[now]].astype(U) * P1), 23) * P2 + P3
        at[now] += 4
        for _ in range(3):
            now = np.flatnonzero(end > at)
            if not len(now):
                break
            h[now] = _turn(h[now] ^ (padded[at[now]].astype(U) * P5), 11) * P1
            at[now] += 1
        h = (h ^ (h >> U(33))) * P2
        h = (h ^ (h >> U(29))) * P3
    return h ^ (h >> U(32))
