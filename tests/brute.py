"""Plain numpy versions of the space-time rules, for small inputs."""

import datetime as dt
import math

import numpy as np

EVENT_SCHEMA = "event_id long, time_utc timestamp, latitude double, longitude double, magnitude double, depth_km double"
START = dt.datetime(2024, 1, 1)


def km(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = (np.radians(x) for x in (lat1, lon1, lat2, lon2))
    a = np.sin((lat2 - lat1) / 2) ** 2 + np.cos(lat1) * np.cos(lat2) * np.sin((lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(np.minimum(1, a)))


def event(i, hours=0.0, lat=0.0, lon=100.0, mag=5.0, depth=10.0, seconds=0):
    return (i, START + dt.timedelta(hours=hours, seconds=seconds), lat, lon, mag, depth)


def mainshocks(events):
    strong = [e for e in events if e[4] >= 5.0]
    kept = set()
    for c in strong:
        prior = [p for p in strong if c[1] - dt.timedelta(days=7) <= p[1] < c[1]]
        if not any(km(c[2], c[3], p[2], p[3]) < 100 for p in prior):
            kept.add(c[0])
    return kept


def features(events, snapshots=(1, 3, 6, 12, 24, 48, 72)):
    out = {}
    for m in (e for e in events if e[0] in mainshocks(events)):
        near = [e for e in events if km(m[2], m[3], e[2], e[3]) < 100]
        for h in snapshots:
            at = m[1] + dt.timedelta(hours=h)
            past = [e for e in near if m[1] < e[1] <= at and e[0] != m[0]]

            def back(hours):
                return [e for e in past if e[1] >= at - dt.timedelta(hours=hours)]

            later = [e for e in near if at < e[1] <= at + dt.timedelta(hours=24)]
            out[(str(m[0]), h)] = (
                len(back(1)), len(back(6)), len(back(24)),
                max((e[4] for e in back(6)), default=0.0),
                max((e[4] for e in back(24)), default=0.0),
                int(any(e[4] >= 4.0 for e in later)),
            )
    return out


def scatter(seed, n, lat=(-11, 6), lon=(95, 141), days=40, spread=0.4):
    """Clustered random events with some exact copies of place and time."""
    rng = np.random.default_rng(seed)
    centres = np.column_stack([rng.uniform(*lat, 6), rng.uniform(*lon, 6)])
    rows = []
    for i in range(n):
        c = centres[rng.integers(6)]
        rows.append(
            event(
                i,
                float(np.round(rng.uniform(0, days * 24), 1)),
                float(np.clip(c[0] + rng.normal(0, spread), -90, 90)),
                float(c[1] + rng.normal(0, spread)),
                float(np.round(rng.uniform(3.0, 6.0), 1)),
            )
        )
    copies = [(n + k, *rows[j][1:]) for k, j in enumerate(rng.integers(0, n, n // 10))]
    return rows + copies


def average_precision(y, p):
    """Step-wise area, one threshold at a time."""
    total, area, seen = sum(y), 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hits = sum(a for a, s in zip(y, p) if s >= t)
        claimed = sum(1 for s in p if s >= t)
        area += (hits / total - seen) * (hits / claimed)
        seen = hits / total
    return area


def isclose(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
