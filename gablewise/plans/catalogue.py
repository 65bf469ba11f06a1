"""All queries of the library, and their SQL."""

from gablewise.plans import deliverables, inputs, layers, merges, outlines, records, results, roads, signs, spatial, streets, verdicts
from gablewise.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "deliverables", "inputs", "layers", "merges", "outlines", "records", "results", "roads", "signs", "spatial", "streets", "verdicts"]
