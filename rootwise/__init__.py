"""Formula graphs on Spark."""

from rootwise.model import ROOT_ID, FormulaGraph, GraphError
from rootwise.scratch import clear_round_tables

__all__ = ["ROOT_ID", "FormulaGraph", "GraphError", "clear_round_tables"]
