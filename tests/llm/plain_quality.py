"""Quality rules by brute force: numpy over whole groups in memory."""

from collections import defaultdict

import numpy as np

from tapeworks.llm import quality_rules as q


def quantile(values, share):
    return np.quantile(values, share, axis=0, method="inverted_cdf")


def moments(x):
    """Sums of 1, x and products of x, as one matrix."""
    one = np.hstack([np.ones((len(x), 1)), x])
    return one.T @ one


def drawn(sums, prior):
    """Each (language, source)'s matrix of sums plus ``prior`` rows of its language's, which has as many of all."""
    languages = defaultdict(float)
    for (lang, _), m in sums.items():
        languages[lang] = languages[lang] + m
    whole = sum(languages.values())
    languages = {lang: m + prior * whole / whole[0, 0] for lang, m in languages.items()}
    return {g: m + prior * languages[g[0]] / languages[g[0]][0, 0] for g, m in sums.items()}


def solve(sums, prior, factor, floor):
    found = {}
    for g, m in drawn(sums, prior).items():
        m = m / m[0, 0]
        found[g] = (m[0, 1:], factor * (m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])) + np.diag(np.square(floor)))
    return found


def distances(groups, found):
    return {g: ((x - found[g][0]) @ np.linalg.inv(found[g][1]) * (x - found[g][0])).sum(1) for g, x in groups.items()}


def start_sums(x, form, floor):
    middle = quantile(x, 0.5)
    spread = 1.4826 * quantile(np.abs(x - middle), 0.5)
    z = (x - middle) / np.maximum(spread, floor)
    r = np.eye(len(floor))
    if form is not None:
        y = form(z)
        products = y.T @ y
        size = np.sqrt(np.outer(np.diag(products), np.diag(products)))
        r = np.where(size > 0, products / np.where(size > 0, size, 1), 0)
        np.fill_diagonal(r, 1)
    matrix = np.empty((len(floor) + 1,) * 2)
    matrix[0, 0], matrix[0, 1:], matrix[1:, 0] = 1, middle, middle
    matrix[1:, 1:] = np.outer(middle, middle) + r * np.outer(spread, spread)
    return len(x) * matrix


def estimates(groups, prior=q.PRIOR):
    """``{(language, source): (centre, covariance)}`` of ``{(language, source): rows}``."""
    floor = np.array(list(q.STATISTICS.values()))
    forms = [None, np.tanh, lambda z: z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)]
    best = {}
    for form in forms:
        found = solve({g: start_sums(x, form, floor) for g, x in groups.items()}, prior, 1.0, floor)
        for _ in range(q.STEPS):
            away = distances(groups, found)
            everything = quantile(np.concatenate(list(away.values())), q.SHARE)
            limits = {}
            for lang in {g[0] for g in groups}:
                of = np.concatenate([d for g, d in away.items() if g[0] == lang])
                limits[lang] = (len(of) * quantile(of, q.SHARE) + prior * everything) / (len(of) + prior)
            limit = {g: (len(d) * quantile(d, q.SHARE) + prior * limits[g[0]]) / (len(d) + prior) for g, d in away.items()}
            near = {g: moments(x[away[g] <= limit[g]]) for g, x in groups.items()}
            found = solve(near, prior, q.consistency(q.SHARE, 5), floor)
        for g, (mu, cov) in found.items():
            size = np.linalg.slogdet(cov)[1]
            if g not in best or size < best[g][0] - 1e-9:
                best[g] = (size, mu, cov)
    best = {g: found[1:] for g, found in best.items()}
    away = distances(groups, best)
    inner = {g: moments(x[away[g] <= q.chi_square_quantile(0.975, 5)]) for g, x in groups.items()}
    return solve(inner, prior, q.consistency(0.975, 5), floor)


def judged(rows, counts):
    """``{position: (base_failed, kept, distance)}`` of rows with ``lang, source`` and their counts."""
    answer, groups, places = {}, defaultdict(list), defaultdict(list)
    for i, (row, (n, c, s, d, r)) in enumerate(zip(rows, counts)):
        if n < q.MIN_WORDS or 100 * r > 50 * n:
            answer[i] = (True, False, None)
            continue
        g = (row.lang or "", row.source or "")
        groups[g].append([np.log(n), c / n, np.sqrt(s / n), np.sqrt(d / n), np.sqrt(r / n)])
        places[g].append(i)
    groups = {g: np.array(x) for g, x in groups.items()}
    away = distances(groups, estimates(groups)) if groups else {}
    for g, numbers in places.items():
        for i, distance in zip(numbers, away[g]):
            answer[i] = (False, bool(distance <= q.chi_square_quantile(1 - q.TAIL, 5)), distance)
    return answer
