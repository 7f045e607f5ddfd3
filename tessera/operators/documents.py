"""Documents and queries as texts: templates, hashes, and fitting to a token budget."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import ordered_labels, sections
from tessera.operators.scratch import small_batches

TokenCounter = Callable[[list[str]], list[int]]


def count_words(texts: list[str]) -> list[int]:
    """White-space words: the default counter; a model's tokenizer can take its place."""
    return [len(t.split()) for t in texts]


def semantic_text(label: Column, description: Column, definition: Column, scope: Column, path: Column) -> Column:
    """Labelled lines; a definition equal to the description is left out."""
    own = F.when(~definition.eqNullSafe(description), definition)
    return sections(("Occupation", label), ("Description", description), ("Definition", own), ("Scope note", scope), ("Context path", path))


def lexical_text(*labels: Column) -> Column:
    """All labels, one a line."""
    return F.array_join(ordered_labels(*labels), "\n")


def label_query(title: Column, terminals: Column) -> Column:
    return sections(("Title", title), ("IT categories", F.array_join(F.array_distinct(terminals), "; ")))


def semantic_query(title: Column, paths: Column, duties: Column, needs: Column) -> Column:
    return sections(("Title", title), ("Category context", F.array_join(F.array_distinct(paths), "; ")), ("Responsibilities", duties), ("Requirements", needs))


@dataclass(frozen=True)
class Section:
    """A part of a query; lower priorities are shortened first."""

    name: str
    header: str
    body: str
    priority: int


@dataclass(frozen=True)
class Fitted:
    text: str
    tokens_before: int
    tokens: int
    shortened: tuple[str, ...]

    @property
    def truncated(self) -> bool:
        return bool(self.shortened) or self.tokens != self.tokens_before


def _compose(parts: Sequence[Section], bodies: dict[str, str]) -> str:
    return "\n".join(f"{p.header}: {bodies[p.name]}" for p in parts if bodies[p.name])


def fit(parts: Sequence[Section], budget: int, instruction: str = "", count: TokenCounter = count_words, margin: int = 8, rounds: int = 3) -> Fitted:
    """A query that fits the budget. Sections are cut from the lowest priority up, in at
    most `rounds` rounds each, to the characters that their share of the budget allows;
    as a last resort the whole text is cut in proportion. The instruction isn't cut as a
    section."""
    lead = f"{instruction}\nQuery: " if instruction else ""
    bodies = {p.name: p.body for p in parts}
    text = lead + _compose(parts, bodies)
    before = total = count([text])[0]
    shortened = set()
    for part in sorted(parts, key=lambda p: p.priority):
        for _ in range(rounds):
            body = bodies[part.name]
            if total <= budget or not body:
                break
            own = count([f"{part.header}: {body}"])[0]
            room = max(0, budget - margin - (total - own))
            length = room * len(text) // max(total, 1)
            if length >= len(body):
                break
            bodies[part.name] = body[:length].rstrip()
            shortened.add(part.name)
            text = lead + _compose(parts, bodies)
            total = count([text])[0]
    if total > budget:
        text = text[: max(1, len(text) * budget // total - margin)]
        total = count([text])[0]
    return Fitted(text, before, total, tuple(sorted(shortened)))


def fit_column(rows: DataFrame, id_col: str, parts: Sequence[tuple[str, str, str, int]], budget: int, instruction: str = "", count: TokenCounter = count_words) -> DataFrame:
    """id, text, tokens_before, tokens, truncated, shortened of each row's query. parts:
    (name, header, column, priority); null bodies are empty."""
    columns = [F.coalesce(F.col(c), F.lit("")).alias(f"p{i}") for i, (_, _, c, _) in enumerate(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True)
            done = [fit([Section(n, h, b, p) for (n, h, _, p), b in zip(parts, row, strict=True)], budget, instruction, count) for row in bodies]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([d.text for d in done], pa.string()),
                    pa.array([d.tokens_before for d in done], pa.int64()),
                    pa.array([d.tokens for d in done], pa.int64()),
                    pa.array([d.truncated for d in done], pa.bool_()),
                    pa.array([",".join(d.shortened) for d in done], pa.string()),
                ],
                ["id", "text", "tokens_before", "tokens", "truncated", "shortened"],
            )

    small_batches(rows)
    own = rows.select(F.col(id_col).alias("id"), *columns)
    schema = f"id {own.schema['id'].dataType.simpleString()}, text string, tokens_before long, tokens long, truncated boolean, shortened string"
    return own.mapInArrow(run, schema)
