"""Events made up for the tests; what is expected of them follows from the rules by direct sums."""

import json
from math import exp

INTERVALS = [5, 10, 15]
T0 = 1_690_000_000

# (event, user, creator, second): a tie, a stamp earlier than the one before, a silent stretch, a user of one kind only
EVENTS = [
    ("view", "ann", "kiosk", 3),
    ("like", "ann", "kiosk", 4),
    ("view", "bo", "kiosk", 4),
    ("view", "ann", "mill", 4),
    ("like", "cy", "mill", 2),
    ("view", "ann", "kiosk", 8),
    ("like", "ann", "kiosk", 9),
    ("like", "ann", "mill", 7),
    ("view", "bo", "kiosk", 12),
    ("view", "ann", "kiosk", 13),
    ("view", "dee", "mill", 13),
    ("view", "dee", "mill", 13),
    ("like", "cy", "kiosk", 41),
    ("view", "ann", "kiosk", 43),
    ("view", "bo", "mill", 44),
]
MEDIA_GAPS = [0, 6, 13, 20, 45, 51]  # seconds at which one media is viewed, no two in one window


def user_lines(rows=EVENTS):
    return [json.dumps({"eventName": n, "userId": u, "creatorId": c, "eventTs": T0 + t}) for n, u, c, t in rows]


SENTINEL = json.dumps({"eventName": "view", "userId": "sentinel", "eventTs": T0 + 900})


def windows_of(rows=EVENTS, length=5):
    """``{(event, user, window start): (first second, n)}``."""
    out = {}
    for name, user, _, t in rows:
        key = (name, user, t - t % length)
        first, n = out.get(key, (t, 0))
        out[key] = (min(first, t), n + 1)
    return out


def counters_of(rows=EVENTS, intervals=INTERVALS):
    """``{(event, user, window start): [value by interval]}`` at the close of each window."""
    windows = windows_of(rows)
    return {
        (name, user, start): [
            sum(
                n * exp((at - now) / d)
                for (name_, user_, start_), (at, n) in windows.items()
                if (name_, user_) == (name, user) and start_ <= start
            )
            for d in intervals
        ]
        for (name, user, start), (now, _) in windows.items()
    }


def lifetime_of(rows=EVENTS):
    out = {}
    for name, user, _, _ in rows:
        out[name, user] = out.get((name, user), 0) + 1
    return out


def media_lines(media="reel", n=len(MEDIA_GAPS), t0=T0):
    return [
        json.dumps({"eventName": "view", "userId": "u", "creatorId": "mill", "mediaId": media, "eventTs": t0 + t})
        for t in MEDIA_GAPS[:n]
    ]


def media_scores(interval, n=len(MEDIA_GAPS)):
    """The counter's value after each view."""
    return [sum(exp((s - t) / interval) for s in MEDIA_GAPS[: i + 1]) for i, t in enumerate(MEDIA_GAPS[:n])]
