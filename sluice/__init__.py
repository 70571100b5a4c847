"""Composable data-preparation operators for Spark DataFrames."""

from sluice.functions.conditions import Condition, all_of, any_of, condition_from_dict
from sluice.plans.recipe import Recipe, step

__all__ = [
    "Condition",
    "Recipe",
    "all_of",
    "any_of",
    "condition_from_dict",
    "step",
]
