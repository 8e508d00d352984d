"""ETL orchestration: sources -> staging -> standard -> dimensions -> facts.

Materialisation points (each written as Parquet in the shared folder and read
back, so lineage is cut and an executor loss only re-runs the current stage):

* ``std/<table>``  - the 7 standard tables, shared by dimension and fact loads;
* ``dw/<table>``   - dimensions and facts, appended with insert-ignore
  semantics; surrogate keys of dimensions are assigned before the append, so
  every fact load sees stable keys.

Running :func:`load` twice on the same root inserts zero rows the second time;
``load(mode="update")`` instead refreshes rows whose key reappears: a dimension as a
new version folder that is switched to, a fact partition by partition, only those in
which a row is new or differs (``plans/fact_store.py``).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetdw.operators.insert_ignore import insert_ignore, upsert
from fleetdw.operators.surrogate import assign_surrogate_key, assign_unique_key
from fleetdw.plans import dims as D
from fleetdw.plans import fact_store as FS
from fleetdw.plans import facts as FX
from fleetdw.plans.transform import BY_SOURCE, TRANSFORMS
from fleetdw.schemas import NATURAL_KEYS, SYSTEMS
from fleetdw.session import CODEC, fresh_scratch, hadoop_path, release
from fleetdw.sources.adapters import Shapes
from fleetdw.sources.extract import extract_all
from fleetdw.sources.lazy import Lazy

DIM_ORDER = ["dim_grupo", "dim_patio", "dim_cliente", "dim_veiculo"]
FACT_SK = {"fato_locacao": "sk_locacao", "fato_reserva": "sk_reserva",
           "fato_movimentacao_patio": "sk_movimentacao"}


@dataclass
class StarStore:
    spark: SparkSession
    root: str
    counts: dict[str, int] = field(default_factory=dict)
    # table -> folder of its current version (update mode writes new versions)
    versions: dict[str, str] = field(default_factory=dict)
    # rows added to each star store table by the last load (0 everywhere on a re-run)
    inserted: dict[str, int] = field(default_factory=dict)
    # read frames, reused across queries (one file listing / footer read per table);
    # dropped whenever the table is written again
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False)

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def table_path(self, name: str) -> str:
        """The folder of a table's current version. Update mode writes ``name@<number>``
        and a folder counts once its job has committed, so any process that opens the
        same root finds the newest one."""
        if name.startswith("std_"):
            return self.path("std", name)
        if name not in self.versions:
            found = committed(self.spark, self.path("dw", f"{name}@*"))
            self.versions[name] = max(found, key=_number) if found else self.path("dw", name)
        return self.versions[name]

    def exists(self, *parts: str) -> bool:
        """Has a job committed this table? Failing file systems raise."""
        p = self.table_path(parts[-1]) if parts[0] == "dw" and len(parts) == 2 else self.path(*parts)
        return bool(committed(self.spark, p))

    def table(self, name: str) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            df = self.spark.read.parquet(self.table_path(name))
            self._frames[name] = df
        return df

    def written(self, name: str) -> None:
        """Record a write: forget the cached frame, refresh the row count and log
        how many rows the write added (``inserted``, per table, last load)."""
        self._frames.pop(name, None)
        if not name.startswith("std_"):
            before = self.counts.get(name, 0)  # :func:`load` reads it before it writes
            self.counts[name] = _count(self.spark, self.table_path(name))
            self.inserted[name] = self.counts[name] - before

    def dates_fixed(self) -> bool:
        """Did every batch so far come through the persisted staging? It never refreshes a row, so
        a key's date, and with it its month, is the same in all loads."""
        fs, p = hadoop_path(self.spark, self.path("dates_vary"))
        return not fs.exists(p)

    def dates_vary(self) -> None:
        """From now on a key may come again with another date."""
        fs, p = hadoop_path(self.spark, self.path("dates_vary"))
        fs.create(p, True).close()

    def new_version(self, name: str) -> str:
        """A folder for the next version of ``name`` (write new, then switch)."""
        return self.path("dw", f"{name}@{_number(self.table_path(name)) + 1:06d}")

    def switch(self, name: str, path: str) -> None:
        """The committed folder ``path`` is the current version from now on. The one before
        stays for readers that have it open; what is older goes."""
        self.versions[name] = path
        for old in [self.path("dw", name), *committed(self.spark, self.path("dw", f"{name}@*"))]:
            if _number(old) < _number(path) - 1 and committed(self.spark, old):
                hadoop_path(self.spark, old)[0].delete(hadoop_path(self.spark, old)[1], True)

    def tables(self) -> Lazy:
        names = ["dim_tempo", *DIM_ORDER, *FACT_SK]
        return Lazy({n: (lambda n=n: self.table(n)) for n in names})

    def std(self) -> Lazy:
        return Lazy({n: (lambda n=n: self.table(n)) for n in TRANSFORMS})

    def dims(self) -> FX.Dims:
        return FX.Dims({n: self.table(n) for n in DIM_ORDER}, self.counts)


def committed(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching ``pattern`` that hold a job-commit marker."""
    fs, p = hadoop_path(spark, f"{pattern}/_SUCCESS")
    return [str(f.getPath().getParent().toString()) for f in fs.globStatus(p) or []]


def _number(path: str) -> int:
    tail = path.rstrip("/").rpartition("@")[2]
    return int(tail) if tail.isdigit() else 0


def _count(spark: SparkSession, path: str) -> int:
    return int(spark.read.parquet(path).count())  # parquet footers only


#: Jobs that run at once. Each keeps its plans, generated code, threads and broadcasts in the driver, and its
#: shuffle files on disk; a few are enough to fill the gaps between small stages.
WORKERS = 4
#: Of those that move a fact's rows.
LARGE_WORKERS = 2


def _in_parallel(tasks: dict[str, callable], workers: int = WORKERS) -> None:
    """Independent Spark jobs submitted from driver threads, so small stages
    overlap instead of queueing behind each other."""
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = [pool.submit(fn) for fn in tasks.values()]
        for f in futures:
            f.result()


def stage_std(spark: SparkSession, sf_dir: str, wh: StarStore) -> None:
    """Extract + transform of the driver tables: raw staging, then ``std/``."""
    stage_sources(Shapes(spark, sf_dir).all_sources(), wh, persist_staging_tables=True)


# Primary key of each raw staging table (the extracts' ON CONFLICT target).
STAGING_KEYS = {"patio": "id_patio_origem", "cliente": "id_cliente_origem", "veiculo": "id_veiculo_origem",
                "reserva": "id_reserva_origem", "locacao": "id_locacao_origem",
                "movimentacao": "id_movimentacao_origem"}
#: Staging tables of a few columns a vehicle, customer or yard; the others have the facts' rows.
SMALL_ENTITIES = ("patio", "cliente", "veiculo")


def persist_staging(stg: dict[str, dict[str, DataFrame]], wh: StarStore) -> dict[str, Lazy]:
    """Insert-ignore every extract into its raw staging table ``stg/<letter>_<entity>``.

    This is the reference's staging layer: a row, once staged, is never refreshed
    (D11: a rental staged while open stays open), and re-running the extracts is
    idempotent. Returns the persisted tables for the transform.
    """
    spark = wh.spark

    def name(letter: str, entity: str) -> str:
        return f"{letter.lower()}_{entity}"

    def one(letter: str, entity: str) -> None:
        path = wh.path("stg", name(letter, entity))
        existing = spark.read.parquet(path) if wh.exists("stg", name(letter, entity)) else None
        batch = stg[letter][entity]
        key = STAGING_KEYS[entity]
        new = insert_ignore(existing, batch, [key], [c for c in batch.columns if c != key])
        new.write.mode("append").parquet(path, compression=CODEC)
        del existing, batch, new
        release(spark, path)

    jobs = [(p, e) for p in stg for e in stg[p]]
    small = [x for x in jobs if x[1] in SMALL_ENTITIES]
    large = [x for x in jobs if x[1] not in SMALL_ENTITIES]
    for some, workers in ((small, WORKERS), (large, LARGE_WORKERS)):
        _in_parallel({f"{p}{e}": (lambda p=p, e=e: one(p, e)) for p, e in some}, workers)
    return {p: Lazy({e: (lambda p=p, e=e: spark.read.parquet(wh.path("stg", name(p, e)))) for e in stg[p]})
            for p in stg}


def stage_sources(sources: dict[str, dict[str, DataFrame]], wh: StarStore,
                  persist_staging_tables: bool = False) -> None:
    """Extract + transform of four source shapes, written to ``std/`` (drop and rebuild).

    With ``persist_staging_tables`` the extracts first go through the persisted,
    insert-ignore raw staging layer (:func:`persist_staging`)."""
    stg = extract_all(sources)
    if persist_staging_tables:
        stg = persist_staging(stg, wh)
    else:
        wh.dates_vary()

    def write(name: str) -> None:  # each thread builds only the frames its table reads
        path = wh.path("std", name)
        if name in BY_SOURCE:  # its joins move all rows: those of one source at a time
            for i, letter in enumerate("ABCD"):
                rows = BY_SOURCE[name](stg, letter)
                rows.write.mode("append" if i else "overwrite").parquet(path, compression=CODEC)
                del rows
                release(wh.spark, path)
        else:
            TRANSFORMS[name](stg).write.mode("overwrite").parquet(path, compression=CODEC)
        wh.written(name)

    _in_parallel({name: (lambda name=name: write(name)) for name in TRANSFORMS})


ROWS_PER_KEY_PARTITION = 2_000_000
DIM_SOURCE = {"dim_patio": "std_patio", "dim_cliente": "std_cliente", "dim_grupo": "std_grupo",
              "dim_veiculo": "std_veiculo"}


def _key_partitions(wh: StarStore, name: str) -> int:
    """Range partitions for numbering ``name``: sized from its standard table's row
    count (Parquet footers), at most the session's shuffle partitions."""
    rows = _count(wh.spark, wh.table_path(DIM_SOURCE[name]))
    cap = int(wh.spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(cap, -(-rows // ROWS_PER_KEY_PARTITION)))


def _append_dim(wh: StarStore, name: str, new_rows: DataFrame) -> None:
    spark = wh.spark
    sk = D.SK_COLUMN[name]
    path = wh.table_path(name)
    start = 1
    if wh.exists("dw", name):
        mx = spark.read.parquet(path).agg(F.max(sk)).collect()[0][0]
        start = int(mx or 0) + 1
    keyed = assign_surrogate_key(new_rows, NATURAL_KEYS[name], sk, start=start,
                                 num_partitions=_key_partitions(wh, name))
    keyed.write.mode("append").parquet(path, compression=CODEC)
    wh.written(name)


def _refresh_dim(wh: StarStore, name: str, std: dict[str, DataFrame]) -> None:
    """Update mode (SCD type 1): attributes of known keys are replaced, their
    surrogate keys kept; unknown keys get new keys after the current maximum."""
    spark = wh.spark
    sk, keys = D.SK_COLUMN[name], NATURAL_KEYS[name]
    existing = wh.table(name)
    batch = D.dim_rows(name, std, None)
    full = upsert(existing.drop(sk), batch, keys, D.TIE_BREAK[name])
    old = existing.select(*keys, sk)
    known = full.join(old, keys, "inner").select(sk, *D.DIM_COLUMNS[name])
    fresh = full.join(old, keys, "left_anti").select(*D.DIM_COLUMNS[name])
    start = int(existing.agg(F.max(sk)).collect()[0][0] or 0) + 1
    out = known.unionByName(assign_surrogate_key(fresh, keys, sk, start=start,
                                                 num_partitions=_key_partitions(wh, name)))
    path = wh.new_version(name)
    out.write.mode("overwrite").parquet(path, compression=CODEC)
    wh.switch(name, path)
    wh.written(name)


def load(spark: SparkSession, wh: StarStore, mode: str = "ignore") -> StarStore:
    """Dimension then fact loads from ``std/`` into ``dw/``.

    ``mode="ignore"`` is ON CONFLICT DO NOTHING (append new keys only);
    ``mode="update"`` replaces rows whose natural key reappears (a rental that was
    open at the last load and is returned now): dimensions as a new version folder,
    facts in the partitions that a new or differing row touches.
    """
    if mode not in ("ignore", "update"):
        raise ValueError(mode)
    std = wh.std()
    for name in FACT_SK:
        if FS.finish_pending(spark, name, wh.table_path(name)):
            wh._frames.pop(name, None)
    for name in ("dim_tempo", *DIM_ORDER, *FACT_SK):  # what is there before, for ``inserted``
        wh.counts[name] = _count(spark, wh.table_path(name)) if wh.exists("dw", name) else 0

    def tempo() -> None:
        path = wh.table_path("dim_tempo")
        existing = spark.read.parquet(path) if wh.exists("dw", "dim_tempo") else None
        D.dim_tempo_rows(spark, std, existing).write.mode("append").parquet(path)
        wh.written("dim_tempo")

    def dim(name: str) -> None:
        if mode == "update" and wh.exists("dw", name):
            _refresh_dim(wh, name, std)
            return
        existing = wh.table(name) if wh.exists("dw", name) else None
        _append_dim(wh, name, D.dim_rows(name, std, existing))

    tasks = {"dim_tempo": tempo}
    tasks.update({name: (lambda name=name: dim(name)) for name in DIM_ORDER})
    _in_parallel(tasks)

    def fact(name: str) -> None:
        load_fact(wh, name, std[FX.BUILDERS[name][0]], mode)

    def reservations_then_rentals() -> None:  # a rental carries its reservation's quantity
        fact("fato_reserva")
        fact("fato_locacao")

    _in_parallel({"movements": lambda: fact("fato_movimentacao_patio"), "rentals": reservations_then_rentals})
    return wh


#: A load of more rows goes source by source: reading the dimensions for each costs less disk and memory, more time.
ROWS_AT_ONCE = 10_000_000


def _by_source(batch: DataFrame) -> list[DataFrame]:
    """``batch`` in parts with rows, of one source each; the last has the rows of no known source. The
    source is part of every fact's key, so no key is in two parts."""
    source = F.col("id_sistema_origem")
    known = source.isin(*SYSTEMS)
    here = {r[0] for r in batch.select(F.when(known, source)).distinct().collect()}
    parts = [batch.where(source == s) for s in SYSTEMS if s in here]
    return parts + [batch.where(source.isNull() | ~known)] * (None in here)


def load_fact(wh: StarStore, name: str, batch: DataFrame, mode: str = "ignore", batch_rows: int | None = None) -> None:
    """Load a batch of standard rows into a fact: insert-ignore, or refresh the partitions that a
    new or differing row touches.

    The conflict check reads the batch's months only, if a key's date cannot have changed."""
    spark = wh.spark
    std_name, build = FX.BUILDERS[name]
    sk, keys, path = FACT_SK[name], NATURAL_KEYS[name], wh.table_path(name)
    existing, start = None, 1
    if batch_rows is None:  # a known size lets a small batch's keys probe the fact map-side
        batch_rows = _count(spark, wh.table_path(std_name))
    if wh.exists("dw", name):
        existing = wh.table(name)
        start = int(existing.agg(F.max(sk)).collect()[0][0] or 0) + 1

    def complete(rows: DataFrame) -> DataFrame:
        if name == "fato_locacao":
            rows = FS.with_requested(rows, wh.table("fato_reserva"))
        return FS.laid_out(name, rows)

    if mode == "update" and existing is not None:
        rows = complete(build(batch, wh.dims(), None)).select(*[c for c in existing.columns if c != sk])
        rows.write.parquet(at := fresh_scratch(spark, f"batch-{name}"))
        rows = spark.read.schema(rows.schema).parquet(at)
        changes = FS.differing(name, existing, rows, keys, sk, start, batch_rows <= FS.SMALL_BATCH)
        changes.write.parquet(at := fresh_scratch(spark, f"changes-{name}"))
        changes = spark.read.schema(changes.schema).parquet(at)
        FS.refresh(name, path, existing, changes, keys, lambda: FS.finish_pending(spark, name, path))
    else:
        if existing is not None and wh.dates_fixed():
            existing = FS.in_months(existing, FS.hit_months(name, batch))
        for i, part in enumerate(_by_source(batch) if batch_rows > ROWS_AT_ONCE else [batch]):
            if i:  # keys go on after those of the part before, if it had rows to load
                written = spark.read.schema(schema).parquet(path)
                start = max(start, int(written.agg(F.max(sk)).collect()[0][0] or 0) + 1)
            rows = assign_unique_key(complete(build(part, wh.dims(), existing, batch_rows)), sk, start)
            schema = rows.schema
            FS.write(name, rows, path)
            del rows
            release(spark, path)
    wh.written(name)


def build_store(spark: SparkSession, sf_dir: str, root: str | None = None) -> StarStore:
    wh = StarStore(spark, root or fresh_scratch(spark, "star"))
    stage_std(spark, sf_dir, wh)
    return load(spark, wh)


def build_from_sources(spark: SparkSession, sources: dict[str, dict[str, DataFrame]],
                       root: str | None = None, persist_staging_tables: bool = True) -> StarStore:
    """Full ETL from already-shaped source tables (``sources[letter][table]``)."""
    wh = StarStore(spark, root or fresh_scratch(spark, "star"))
    stage_sources(sources, wh, persist_staging_tables)
    return load(spark, wh)


_CACHE: dict[tuple[int, str], tuple[StarStore, tuple]] = {}


def input_stamp(spark: SparkSession, folder: str) -> tuple:
    """Name, length and modification time of a folder's Parquet files (a few listing calls)."""
    out = []
    for pattern in ("*.parquet", "*.parquet/*"):
        fs, p = hadoop_path(spark, f"{folder.rstrip('/')}/{pattern}")
        out += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.globStatus(p) or []]
    return tuple(out)


def store_for(spark: SparkSession, sf_dir: str) -> StarStore:
    """Build once per (session, input folder) as long as the folder's files stay the same;
    reports then read the written tables."""
    key, stamp = (id(spark._jsparkSession), sf_dir.rstrip("/")), input_stamp(spark, sf_dir)
    wh, seen = _CACHE.get(key, (None, None))
    # ids can be reused after a session is stopped: only trust a build of this very session
    if wh is None or seen != stamp or wh.spark is not spark or not wh.exists("dw", "fato_locacao"):
        wh = build_store(spark, sf_dir)
        _CACHE[key] = wh, stamp
    return wh
