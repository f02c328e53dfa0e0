"""Operators of a training-data pipeline, with their queries and the SQL of those that have one."""

from . import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13"]
