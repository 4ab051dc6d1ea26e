from tierflow.plans.flows import bronze_to_silver, dimension_to_silver, events_to_silver, silver_to_gold, source_to_bronze
from tierflow.plans.gold import SilverTables, gold_wide, publish_views

__all__ = [name for name in dir() if not name.startswith("_")]
