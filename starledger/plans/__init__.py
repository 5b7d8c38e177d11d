"""From the read tables to answers: silver tables, the gold table, insights, and SQL exploration."""

from starledger.plans import exploration, insights
from starledger.plans.gold import gold, store_gold
from starledger.plans.silver import films, movies_silver, ratings_silver

__all__ = ["exploration", "films", "gold", "insights", "movies_silver", "ratings_silver", "store_gold"]
