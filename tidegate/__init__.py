"""tidegate: contract-driven table ingestion and loading on PySpark DataFrames."""

from tidegate.contract import STRATEGIES, ContractError, TableContract

__all__ = ["STRATEGIES", "ContractError", "TableContract"]
