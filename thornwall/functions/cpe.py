"""Product names (CPE 2.3) and configuration trees of CVE records, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a formatted name behind its "cpe:2.3" head, in order.
PARTS = ("part", "vendor", "product", "version", "update", "edition", "language", "sw_edition", "target_sw", "target_hw", "other")
ANY, NOTHING = "*", "-"

_MATCH = "cpeMatch:array<struct<vulnerable:boolean,criteria:string>>"
_LEAF = f"struct<operator:string,negate:boolean,{_MATCH}>"
_NODE = f"struct<operator:string,negate:boolean,{_MATCH},children:array<{_LEAF}>>"
#: Configurations of a record: nodes with matches, and nodes below nodes.
CONFIGURATIONS = f"array<struct<operator:string,negate:boolean,nodes:array<{_NODE}>>>"


def cpe(name: Column) -> Column:
    """A struct of the parts of a formatted name; null for what is none.

    Colons and other signs may be escaped by a backslash, which is taken away.
    A whole part ``*`` stands for any value and ``-`` for none; both are null
    here, escaped ones are not.
    """
    parts = F.regexp_extract_all(name, F.lit(r"((?:[^:\\]|\\.)*)(?::|$)"), F.lit(1))
    sound = name.startswith("cpe:2.3:") & (F.size(parts) >= len(PARTS) + 2)

    def part(i: int) -> Column:
        text = F.get(parts, F.lit(i + 2))
        return F.when(~text.isin(ANY, NOTHING), F.regexp_replace(text, r"\\(.)", "$1"))

    return F.when(sound, F.struct(*(part(i).alias(name_) for i, name_ in enumerate(PARTS))))


def _affirmed(nodes: Column) -> Column:
    return F.filter(nodes, lambda n: ~F.coalesce(n["negate"], F.lit(False)))


def affected(configurations: Column) -> Column:
    """The names a record calls vulnerable, each once, from all nodes of its configurations that are not negated.

    AND and OR make no difference to who is named: a platform a product runs on
    is in the tree as a match that is not vulnerable.
    """
    nodes = F.flatten(F.transform(_affirmed(configurations), lambda c: F.coalesce(_affirmed(c["nodes"]), F.array())))
    own = F.flatten(F.transform(nodes, lambda n: F.coalesce(n["cpeMatch"], F.array())))
    below = F.flatten(F.transform(nodes, lambda n: F.coalesce(_affirmed(n["children"]), F.array())))
    deeper = F.flatten(F.transform(below, lambda n: F.coalesce(n["cpeMatch"], F.array())))
    named = F.filter(F.concat(own, deeper), lambda m: F.coalesce(m["vulnerable"], F.lit(False)))
    return F.array_distinct(F.transform(named, lambda m: m["criteria"]))


def vendors(configurations: Column) -> Column:
    """The vendors of all affected products, each once."""
    return F.array_compact(F.array_distinct(F.transform(affected(configurations), lambda name: cpe(name)["vendor"])))
