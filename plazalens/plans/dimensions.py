"""Loading the dashboard's dimension tables."""

from pyspark.sql import DataFrame

from plazalens.sinks.tables import category_table, seed_table


def load_dimensions(seeds: DataFrame, categories: DataFrame, out: str) -> None:
    """Replaces both tables, so that a repeated load does not double them."""
    seed_table(seeds).write.mode("overwrite").parquet(f"{out}/metadata")
    category_table(categories).write.mode("overwrite").parquet(f"{out}/insult_to_group")
