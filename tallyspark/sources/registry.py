"""Process registry (which queues exist, how their ERP match runs) and the
fiscal-year parameter.

The registry is a short ordered list held by the driver; it only decides
which queue DataFrames are unioned and how each is keyed.  Its order is
kept through an explicit ``ordinal`` column.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import MISSING, asdict, dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# How a process is matched against the ERP tables.
KIND_PURCHASE = "purchase"  # contract key = doc_compra, purchase contract block
KIND_STORAGE = "storage"  # contract key = LPAD(n_contrato, 10, '0'), sales block
KIND_VALUE = "value"  # value complement: tax-id route with a date anchor


@dataclass(frozen=True)
class ProcessDef:
    process_name: str
    ordinal: int
    kind: str
    tipo_processo: str
    queue_table: str
    statuses: tuple[str, ...]
    target_table: str = "complemento_notas_escrituracao"
    active: bool = True
    truncate_before_insert: bool = False
    drop_and_create: bool = False
    aa_file_id: int | None = None

    @property
    def save_strategy(self) -> str:
        if self.drop_and_create:
            return "DROP_CREATE"
        if self.truncate_before_insert:
            return "TRUNCATE"
        return "APPEND"


# --- fixed values: the five processes, in registry order ---------------------
DEFAULT_PROCESSES: tuple[ProcessDef, ...] = (
    ProcessDef("V2_Consulta_Comp_CTRFIXO", 1, KIND_PURCHASE, "COM_CTR_FIXO",
               "complemento_quantidade_fixo_fila", ("12", "13"), aa_file_id=1211403),
    ProcessDef("V2_Consulta_Comp_CTR_S_FIXACAO", 2, KIND_PURCHASE, "COM_CTR_S_FIXACAO",
               "complemento_quantidade_sem_fixacao_fila", ("12", "13", "9"), aa_file_id=1266717),
    ProcessDef("V2_Consulta_Comp_CTR_C_FIXACAO", 3, KIND_PURCHASE, "COM_CTR_C_FIXACAO",
               "complemento_quantidade_com_fixacao_fila", ("12", "13"), aa_file_id=1233302),
    ProcessDef("V2_Consulta_Comp_ARMAZEN", 4, KIND_STORAGE, "COM_CTR_ARMAZEN",
               "complemento_quantidade_deposito_fila", ("12", "13"), aa_file_id=1310535),
    ProcessDef("V2_Consulta_Comp_VALOR", 5, KIND_VALUE, "COMP_VALOR",
               "complem_valor_fila", ("01",), aa_file_id=None),
)


def active_processes(processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> list[ProcessDef]:
    """Active processes in registry order."""
    return sorted((p for p in processes if p.active), key=lambda p: p.ordinal)


def get_process(name: str, processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> ProcessDef:
    for p in processes:
        if p.process_name == name:
            return p
    raise KeyError(f"process not in registry: {name}")


def with_active(processes: Sequence[ProcessDef], names: Iterable[str]) -> list[ProcessDef]:
    """The registry with just the named processes active; an unknown name raises."""
    keep = set(names)
    unknown = keep - {p.process_name for p in processes}
    if unknown:
        raise KeyError(f"processes not in registry: {sorted(unknown)}")
    return [replace(p, active=p.process_name in keep) for p in processes]


# --- S4: the registry from a configuration -----------------------------------
def process_from(entry: Mapping, ordinal: int) -> ProcessDef:
    """One configured process; its place in the file is its ordinal.  Unknown,
    missing and wrongly typed entries raise with the process and the field."""
    known = {f.name: f for f in fields(ProcessDef) if f.name != "ordinal"}
    where = f"process {entry.get('process_name', f'number {ordinal}')!r}"
    if unknown := sorted(set(entry) - set(known)):
        raise ValueError(f"{where}: unknown fields {unknown}")
    if missing := sorted(n for n, f in known.items() if f.default is MISSING and n not in entry):
        raise ValueError(f"{where}: missing fields {missing}")
    values = {**entry, "statuses": tuple(str(s) for s in entry["statuses"])} if isinstance(entry["statuses"], list) else dict(entry)
    for name, kind in (("process_name", str), ("tipo_processo", str), ("queue_table", str), ("target_table", str), ("statuses", tuple),
                       ("active", bool), ("truncate_before_insert", bool), ("drop_and_create", bool), ("aa_file_id", (int, type(None)))):
        if name in values and (not isinstance(values[name], kind) or values[name] in ("", ())):
            raise ValueError(f"{where}: {name} is {values[name]!r}")
    if values["kind"] not in (KIND_PURCHASE, KIND_STORAGE, KIND_VALUE):
        raise ValueError(f"{where}: unknown kind {values['kind']!r}")
    return ProcessDef(ordinal=ordinal, **values)


def load_processes(spark: SparkSession, path: str) -> list[ProcessDef]:
    """The registry from a JSON file (``{"processes": [...]}``; YAML too where
    its parser is installed) at any path Spark reads; the file's order is kept
    and a repeated name raises."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"no YAML parser installed for {path}; give JSON") from e
        body = yaml.safe_load(text)
    else:
        body = json.loads(text)
    if not isinstance(body, dict) or not isinstance(body.get("processes"), list):
        raise ValueError(f"{path}: no list of processes")
    out = [process_from(entry, i) for i, entry in enumerate(body["processes"], start=1)]
    seen = [p.process_name for p in out]
    if repeated := sorted({n for n in seen if seen.count(n) > 1}):
        raise ValueError(f"{path}: repeated processes {repeated}")
    return out


def dump_processes(processes: Iterable[ProcessDef]) -> str:
    """The configuration text of a registry, in registry order."""
    ordered = sorted(processes, key=lambda p: p.ordinal)
    return json.dumps({"processes": [{k: v for k, v in asdict(p).items() if k != "ordinal"} for p in ordered]}, indent=2)


REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("PROCESS_NAME", T.StringType(), False),
        T.StructField("ordinal", T.IntegerType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("aa_file_id", T.LongType(), True),
    ]
)


def registry_frame(spark: SparkSession, processes: Iterable[ProcessDef] = DEFAULT_PROCESSES) -> DataFrame:
    """The active registry as a tiny DataFrame (a handful of rows; safe to
    broadcast by construction)."""
    rows = [
        (p.process_name, p.ordinal, p.kind, p.target_table, p.aa_file_id)
        for p in active_processes(processes)
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def parse_years(text: str | None, today: _dt.date | None = None) -> tuple[int, ...]:
    """'2025,2026' -> (2025, 2026); non-digit parts dropped; empty -> this year."""
    parts = [p.strip() for p in (text or "").split(",")]
    years = tuple(int(p) for p in parts if re.fullmatch(r"\d+", p))
    if years:
        return years
    return ((today or _dt.date.today()).year,)
