"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). The cells are raked: their weights are scaled to each marginal target in
turn until all hold. A cell's weight over its tokens, times one factor, is the probability with which its documents are
kept; the factor is the largest with which no probability passes ``most``, or the one that fills the token ``budget``. Where cells would
pass probability 1, the raking goes on under that cap until the targets hold again. A target beyond all tokens of its category takes all of
them, and the others share the rest as their targets are. Targets that contradict each other under the cap hold on the last axis, and
nearly so on the others; no cell falls below a hundredth of the share to keep. ``marginals`` has what is reached. A hash of the id and the text draws the documents, so a rerun keeps
the same ones.

Categories that a target does not name form one category, "other", so there are at most (sources + 1) * (languages + 1) *
(topics + 1) cells whatever the data hold; only their sums reach the driver. Unless the target gives "other" a share, it keeps the one
it has of all tokens, and the named shares are scaled to the rest. A target share whose category has no tokens is spread over the other
named ones.

Defined cases: a null category is "other". Null and empty texts have one token, so that they are drawn like others. Repeated rows
share their draw. Extra columns, whatever their names, pass through ``mix``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"
Targets = Mapping[str, Mapping[str, float]]


def topic(text: Column) -> Column:
    """What a text is, by its form: a table, marked-up or shouted text, a list of short lines, or prose."""
    known = F.coalesce(text, F.lit(""))
    words = F.greatest(F.regexp_count(known, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1))
    share = lambda pattern: F.regexp_count(known, F.lit(pattern)) / words
    return (
        F.when(share(r"\|") > 0.2, "table")
        .when(share(r"[%$&*#!]{2,}") > 0.2, "noise")
        .when(share(r"\n") > 0.2, "lines")
        .otherwise("prose")
    )


def tokens(text: Column) -> Column:
    """Words of the text, 1 at least, as its weight in tokens."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def rake(sums: np.ndarray, targets: list[np.ndarray], rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Weights of the cells, in the proportions of ``sums`` but for a factor per category, that have the target marginals."""
    weights = sums / max(sums.sum(), 1e-300)
    for _ in range(rounds):
        worst = 0.0
        for axis, target in enumerate(targets):
            others = tuple(i for i in range(weights.ndim) if i != axis)
            now = weights.sum(others)
            goal = np.where(now > 0, target, 0.0)
            goal = goal / goal.sum() if goal.sum() > 0 else now
            factor = np.divide(goal, now, out=np.ones_like(now), where=now > 0)
            worst = max(worst, np.abs(now - goal).max(initial=0))
            weights = weights * factor.reshape([-1 if i == axis else 1 for i in range(weights.ndim)])
        if worst < close:
            break
    return weights


def _level(raw: np.ndarray, least: np.ndarray, most: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """A factor for each row of ``raw`` with which its values, cut at ``least`` and ``most``, add up to the row's goal."""
    low = np.full(len(raw), -500.0)
    high = np.full(len(raw), 500.0)
    for _ in range(70):
        middle = (low + high) / 2
        kept = np.clip(raw * np.exp(middle)[:, None], least, most).sum(1)
        low, high = np.where(kept < goal, middle, low), np.where(kept < goal, high, middle)
    return np.exp(high)


def rake_capped(
    raw: np.ndarray, sums: np.ndarray, goals: list[np.ndarray], budget: float, most: float = 1.0, rounds: int = 200, close: float = 1e-9
) -> np.ndarray:
    """Chances in proportion to ``raw`` but for a factor per category, cut at ``most``, that keep ``budget`` tokens with the goals' marginals."""
    high = np.where(raw > 0, most * sums, 0.0)
    low = high * (budget / max(sums.sum(), 1e-300) / 100)
    kept, weights = np.clip(raw * sums, low, high), raw * sums
    for _ in range(rounds):
        before = kept
        for axis, goal in enumerate(goals):
            flat = lambda cells: np.moveaxis(cells, axis, 0).reshape(len(goal), -1)  # noqa: B023, E731
            least, all_ = flat(low).sum(1), flat(high).sum(1)
            # The goals first: no category gives more than it has.
            shares = np.where(all_ > 0, goal, 0.0)[None]
            tokens_ = np.clip(shares * _level(shares, least, all_, np.array([min(budget, all_.sum())])), least, all_)[0]
            factor = _level(flat(weights), flat(low), flat(high), tokens_)
            weights = np.minimum(weights * factor.reshape([-1 if i == axis else 1 for i in range(weights.ndim)]), 1e100)
        kept = np.clip(weights, low, high)
        if np.abs(kept - before).max(initial=0) < close * budget:
            break
    return np.divide(kept, sums, out=np.zeros_like(kept), where=sums > 0)


def probabilities(
    weights: np.ndarray, sums: np.ndarray, budget: float | None, most: float = 1.0, goals: list[np.ndarray] | None = None
) -> np.ndarray:
    """Chance of each cell's documents to stay: weight over tokens, scaled to the budget, ``most`` at most.

    With ``goals``, the marginals' targets, cells are raked again under that cap if one reaches it.
    """
    raw = np.divide(weights, sums, out=np.zeros_like(weights), where=sums > 0)
    if not raw.max(initial=0):
        return raw
    if budget is None:
        return raw * (most / raw.max())
    full = np.zeros(raw.shape, bool)
    for _ in range(raw.size + 1):
        rest = budget - most * sums[full].sum()
        open_ = (sums * raw)[~full].sum()
        chance = np.where(full, most, raw * (max(rest, 0.0) / open_ if open_ > 0 else 0.0))
        over = (chance >= most) & ~full & (raw > 0)
        if not over.any():
            break
        full |= over
    if goals is not None and full.any():
        return rake_capped(chance, sums, goals, budget, most)
    return np.minimum(chance, most)


def goals_of(sums: np.ndarray, targets: Targets, names: list[list[str]]) -> list[np.ndarray]:
    """Shares of each axis's categories that the targets ask for; ``names`` has the categories, the last of them "other"."""
    out = []
    for axis, (own, named) in enumerate(zip(names, targets.values())):
        now = sums.sum(tuple(i for i in range(sums.ndim) if i != axis))
        goal = np.where(now > 0, [float(named.get(n, 0.0)) for n in own], 0.0)
        if OTHER not in named:
            # Documents without a named category are as frequent after as before.
            kept = now[-1] / max(now.sum(), 1e-300)
            goal *= (1 - kept) / goal.sum() if goal.sum() else 0.0
            goal[-1] = kept
        out.append(goal)
    return out


def _category(column: Column, named: Mapping[str, float]) -> Column:
    names = [n for n in named if n != OTHER]
    return F.when(column.isin(names), column).otherwise(F.lit(OTHER))


def calibrated(
    docs: DataFrame, targets: Targets, columns: Mapping[str, Column], keep: float, text: str = "text"
) -> tuple[Column, dict]:
    """A document's cell, and the cells by it: tokens, chance. ``keep``: share of all tokens to stay."""
    cell = F.concat_ws("\x1f", *(_category(columns[c], targets[c]) for c in targets))
    names = [[*(n for n in targets[c] if n != OTHER), OTHER] for c in targets]
    sums = np.zeros([len(n) for n in names])
    # At most one row a cell.
    for key, total in docs.select(cell.alias("cell"), tokens(F.col(text)).alias("tokens")).groupBy("cell").agg(F.sum("tokens")).collect():
        sums[tuple(n.index(part) for n, part in zip(names, key.split("\x1f")))] = total
    goals = goals_of(sums, targets, names)
    chances = probabilities(rake(sums, goals), sums, keep * sums.sum() if sums.sum() else None, goals=goals)
    cells = {
        "\x1f".join(own[i] for own, i in zip(names, at)): (float(sums[at]), float(chances[at])) for at in np.ndindex(sums.shape) if sums[at]
    }
    return cell, cells


def _chance(cell: Column, cells: dict) -> Column:
    chances = [F.lit(x) for key, (_, p) in cells.items() for x in (key, p)]
    return F.element_at(F.create_map(*chances), cell) if chances else F.lit(0.0)


def marginals(cells: dict, targets: Targets) -> dict[str, dict[str, tuple[float | None, float, float]]]:
    """By column and category of ``calibrated``'s cells: target share if named, share of all tokens, share of those expected to stay."""
    out: dict = {c: {} for c in targets}
    tokens_, kept = sum(t for t, _ in cells.values()), sum(t * p for t, p in cells.values())
    for key, (total, chance) in cells.items():
        for column, part in zip(targets, key.split("\x1f")):
            _, whole, stay = out[column].get(part, (None, 0.0, 0.0))
            target = targets[column].get(part)
            out[column][part] = target, whole + total / tokens_, stay + (total * chance / kept if kept else 0.0)
    return out


def draw(doc_id: str, text: str, seed: int) -> Column:
    """A number in [0, 1) that only the id, the text and the seed decide."""
    hashed = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(1 << 53)


def mix(
    docs: DataFrame,
    targets: Targets,
    columns: Mapping[str, Column],
    keep: float = 0.5,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The drawn documents with all their columns; nothing is shuffled but the sums of the cells."""
    cell, cells = calibrated(docs, targets, columns, keep, text)
    return docs.where(draw(doc_id, text, seed) < _chance(cell, cells))


def plan(
    docs: DataFrame,
    targets: Targets,
    columns: Mapping[str, Column],
    keep: float = 0.5,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Every document with its cell, tokens, probability and whether it is drawn."""
    cell, cells = calibrated(docs, targets, columns, keep, text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), cell.alias("cell"), tokens(F.col(text)).alias("tokens"), draw(doc_id, text, seed).alias("draw")
    ).withColumn("probability", _chance(F.col("cell"), cells))
    drawn = (F.col("draw") < F.col("probability")).alias("drawn")
    return rows.select("doc_id", F.translate("cell", "\x1f", "/").alias("cell"), "tokens", "probability", drawn)


#: Production targets: every source alike, languages and topics as given.
SOURCES = {f"src{i}": 1 / 20 for i in range(20)}
LANGUAGES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
TOPICS = {"prose": 0.85, "lines": 0.05, "table": 0.07, "noise": 0.03}
TARGETS: Targets = {"source": SOURCES, "lang": LANGUAGES, "topic": TOPICS}


def columns_of(text: str = "text") -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col(text))}
