"""Reports of runs: one-row tables of counts, and Markdown from small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(**tables: DataFrame) -> DataFrame:
    """One row: the number of rows of each table."""
    parts = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.join(F.broadcast(b)), parts)  # one row each


def coreference_report(resolved: DataFrame, chains: DataFrame) -> DataFrame:
    """``pronouns, resolved, unresolved, chains, mentions`` over all documents."""
    found = F.col("antecedent_mention_id").isNotNull()
    a = resolved.agg(F.count(F.lit(1)).alias("pronouns"), F.count_if(found).alias("resolved"), F.count_if(~found).alias("unresolved"))
    return a.join(F.broadcast(chains.agg(F.count_distinct("doc_id", "chain_id").alias("chains"), F.count(F.lit(1)).alias("mentions"))))


def markdown(title: str, summary: DataFrame, names: dict[str, str]) -> str:
    """A report from ``kind, name, n`` and perhaps ``examples`` (a table of the size of the contract): a section
    for each kind of ``names``, the most frequent first."""
    rows = sorted(summary.collect(), key=lambda r: (-r["n"], r["name"] or ""))
    out = [f"# {title}", ""]
    for kind, head in names.items():
        mine = [r for r in rows if r["kind"] == kind]
        out += [f"## {head}", ""]
        for r in mine:
            some = r["examples"] if "examples" in r else None
            out.append(f"- `{r['name']}`: {r['n']}" + (f" (such as {', '.join(some)})" if some else ""))
        out += [] if mine else ["- none"]
        out.append("")
    return "\n".join(out)
