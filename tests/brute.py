"""Plain loops that compute what the operators should give, for small inputs."""

from datetime import timedelta


def sessions(rows, hours=12, serving=False):
    """(pid, time) pairs -> per pid, a list of (time, ordinal, session start), in time order.

    A time of None opens a session of its own, before all timed readings.
    """
    by_pid = {}
    for pid, time in rows:
        by_pid.setdefault(pid, []).append(time)
    found = {}
    for pid, times in by_pid.items():
        untimed = times.count(None)
        placed = [(None, untimed, None)] * untimed
        ordinal, start, before = untimed, None, None
        for time in sorted(t for t in times if t is not None):
            gap = None if before is None else time - before
            limit = timedelta(hours=hours if serving else hours + 1)
            if gap is None or (gap > limit if serving else gap >= limit):
                ordinal, start = ordinal + 1, time
            placed.append((time, ordinal, start))
            before = time
        found[pid] = placed
    return found


def auc(labels, scores):
    """Share of positive-negative pairs in the right order; ties count half."""
    good = sum(
        1.0 if a > b else 0.5 if a == b else 0.0
        for a, la in zip(scores, labels)
        for b, lb in zip(scores, labels)
        if la == 1 and lb == 0
    )
    positives = sum(labels)
    return good / (positives * (len(labels) - positives))
