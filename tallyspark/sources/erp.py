"""The ERP tables that the matching reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class ErpBlocks:
    """What no work item decides, written once for several reconciles: the
    contract blocks, the open invoices of the years and whether an active
    NF-e has a blank number."""

    years: frozenset[int]
    contracts: DataFrame
    invoices: DataFrame
    blank_active: bool


@dataclass
class ErpTables:
    """The twelve ERP tables the matching reads."""

    zmmt0022: DataFrame  # expected-amounts ledger
    ekko: DataFrame  # purchase header
    ekpo: DataFrame  # purchase item
    mara: DataFrame  # material
    bp_fiscal: DataFrame  # partner tax ids
    vbak: DataFrame  # sales header
    vbap: DataFrame  # sales item
    kna1: DataFrame  # customer
    xml_rec: DataFrame  # received invoice (header)
    nfeit: DataFrame  # received invoice item
    nfe_active: DataFrame  # active NF-e
    nfdoc: DataFrame  # fiscal document
    blocks: ErpBlocks | None = None  # made of these very tables, if they are
