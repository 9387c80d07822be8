"""Plain Python answers to compare small Spark results with."""

from __future__ import annotations

from collections import Counter, defaultdict

import random


def skewed_ratings(seed: int = 1, users: int = 40, items: int = 60, rows: int = 900) -> list[tuple]:
    """(user, item, rating, ts), a third of them by user 1, a third of item 1,
    with repeated pairs. User 2 has rated everything."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        user = 1 if rng.random() < 0.33 else rng.randint(1, users)
        item = 1 if rng.random() < 0.33 else rng.randint(1, items)
        out.append((user, item, rng.randint(1, 5), 1000 + i))
    out += [(2, item, rng.randint(1, 5), 9000 + item) for item in range(1, items + 1)]
    return out


def labelled_items(labels: list[str], seed: int = 2, items: int = 60) -> list[tuple]:
    """(item, title, labels); the first label is on a third of them, item 7 has none."""
    rng = random.Random(seed)
    out = []
    for item in range(1, items + 1):
        picked = {labels[0]} if rng.random() < 0.34 else set()
        picked |= set(rng.sample(labels[1:-1], rng.randint(0, 2)))
        picked = [] if item == 7 else sorted(picked or {labels[1]})
        out.append((item, f'Title "{item}", part|{item % 3}', picked))
    return out


def favourites(ratings, items, min_ratings=1):
    labels = {item: names for item, _, names in items}
    total, counts = Counter(), defaultdict(Counter)
    for user, item, *_ in ratings:
        total[user] += 1
        counts[user].update(labels.get(item, []))
    best = {}
    for user, by_label in counts.items():
        if total[user] >= min_ratings and by_label:
            label = min(by_label, key=lambda name: (-by_label[name], name))
            best[user] = (label, by_label[label])
    return best


def means(ratings):
    by_item = defaultdict(list)
    for _, item, rating, *_ in ratings:
        by_item[item].append(rating)
    return {item: (round(sum(v) / len(v), 4), len(v)) for item, v in by_item.items()}


def best_unrated(ratings, items, n, min_support, descending):
    stats, seen = means(ratings), {(r[0], r[1]) for r in ratings}
    rows = []
    for user, (label, _) in favourites(ratings, items).items():
        open_items = [
            (item, title, stats[item][0])
            for item, title, names in items
            if label in names and item in stats and stats[item][1] >= min_support and (user, item) not in seen
        ]
        open_items.sort(key=lambda x: (-x[2] if descending else x[2], x[0]))
        rows += [(user, k, *entry, label) for k, entry in enumerate(open_items[:n], 1)]
    return sorted(rows)


def holdout(rows, start, stop, max_test):
    """Roles of (position, user) rows taken one after the other."""
    seen, tests, roles = Counter(), 0, {}
    for position, user in sorted(rows):
        seen[user] += 1
        is_test = start <= seen[user] <= stop and (max_test <= 0 or tests < max_test)
        tests += is_test
        roles[position] = "test" if is_test else "base"
    return roles
