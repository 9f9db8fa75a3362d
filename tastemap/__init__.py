"""tastemap: a Spark-native engine for building and scoring top-N recommendations.

Every operator takes and returns DataFrames in long form (one row per user/item pair) and
stays lazy; the only driver round trips are scalar checks (population sizes, broadcast
bounds), per-epoch model weights and grid-loop control.
"""

from tastemap.schema import ITEM, RATING, TS, USER

__all__ = ["USER", "ITEM", "RATING", "TS"]
