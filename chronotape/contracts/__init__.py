"""Declared table shapes and closed vocabularies."""

from chronotape.contracts.catalog import CONTRACTS, contract
from chronotape.contracts.model import Contract, Field, TimeGroup

__all__ = ["CONTRACTS", "Contract", "Field", "TimeGroup", "contract"]
