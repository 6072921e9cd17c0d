"""Tables as graphs on Spark: melt, identify, type, enrich and emit; page and summarise; ask the graph back."""

from .plans.convert import Conversion, convert, manifest, run, summarise
from .vocab import PLAIN, TYPED, Profile

__all__ = ["PLAIN", "TYPED", "Conversion", "Profile", "convert", "manifest", "run", "summarise"]
