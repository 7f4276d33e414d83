"""Reader-facing labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import vocab


def title_case(text: Column) -> Column:
    """Capital at the start of every run of letters, the rest lower case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def branch_label(branch: Column) -> Column:
    """Identifier to a readable name; null reads "None"."""
    return title_case(F.replace(F.coalesce(branch.cast("string"), F.lit("None")), F.lit("_"), F.lit(" ")))


def _lookup(key: Column, labels: Mapping[str, str], fallback: Column) -> Column:
    if not labels:
        return fallback
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), fallback)


def experience_label(aspect: Column, labels: Mapping[str, str] = vocab.EXPERIENCE_LABELS) -> Column:
    """Aspect to its label, title case where it has none."""
    return _lookup(aspect.cast("string"), labels, branch_label(aspect))


def rule_item_label(item: Column, labels: Mapping[str, str] = vocab.RULE_ITEM_LABELS) -> Column:
    """Basket item to readable text."""
    tail = F.regexp_replace(item, "^[^:]*:", "")
    return (
        F.when(item.startswith("aspect:"), F.concat(F.lit("Experience: "), branch_label(tail)))
        .when(item.startswith("sentiment:"), F.concat(F.lit("Customer mood: "), tail))
        .otherwise(_lookup(item, labels, branch_label(item)))
    )


def rule_items_label(items: Column) -> Column:
    """All items of one side of a rule."""
    return F.array_join(F.transform(items, lambda item: rule_item_label(item)), ", ")


def business_frame(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Readable values and column names; of columns with one name the first stays."""
    wanted = df.columns if columns is None else [c for c in columns if c in df.columns]
    shown: dict[str, Column] = {}
    for name in wanted:
        value = F.col(f"`{name}`")
        if name in ("branch_id", "branch_name"):
            value = branch_label(value)
        elif name in ("aspect", "issue"):
            value = experience_label(value)
        shown.setdefault(vocab.COLUMN_LABELS.get(name, name), value)
    return df.select(*(value.alias(label) for label, value in shown.items()))
