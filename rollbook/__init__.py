"""Clinical programme registers as Spark DataFrames."""

from rollbook.plans.register import register, register_generic, register_pk, register_png
from rollbook.sources.mart import Mart

__all__ = ["Mart", "register", "register_generic", "register_pk", "register_png"]
