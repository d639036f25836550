"""The whole model graph as Python calls on DataFrames.

``ref()`` edges of the original become function arguments; views are lazy
DataFrames; the three published tables are written with a full rebuild.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from functools import cached_property
from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from idloom.config import PipelineConfig
from idloom.operators import email as email_ops
from idloom.operators import idmap, quality, spine, staging, timeline
from idloom.operators.observe import observation_map
from idloom.operators.ordered import ROWS_PER_TASK, tasks_for
from idloom.plans.writers import write_table
from idloom.session import materialize, remove_written

# Schema folder of each model group.
MODEL_FOLDER = {"core": "core", "staging": "staging", "staging_clean": "staging"}

# Which models read which.
MODEL_READS = {
    "stg_tiktok_id_handle_map_time": ("stg_tiktok_id_handle_map",),
    "stg_creator": ("stg_tiktok_id_handle_map_time", "stg_tiktok_id_handle_map"),
    "dim_creator_handle_log": ("stg_tiktok_id_handle_map_time",),
}
#: Models that more than one projection of a source goes into, by dependency.
SHAREABLE = {"stg_tiktok_id_handle_map": "observations", "stg_tiktok_id_handle_map_time": "timeline", "dim_creator_handle_log": "handle_log"}


def target_schema(env: str, custom_schema: str | None, base_schema: str) -> str:
    """Schema a model is written to: in "prod" the folder's schema in upper
    case (or the base schema upper-cased when the folder names none); in any
    other environment everything goes to the base schema unchanged."""
    if env == "prod":
        return (custom_schema or base_schema).upper()
    return base_schema


class CleanModels(Mapping):
    """Cleaned models, built on first access (lazy like the original views)."""

    def __init__(self, raw, mode: str, missing: str, blank_ids: bool = False):
        self._raw, self._mode, self._missing, self._blank = raw, mode, missing, blank_ids
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = staging.clean_source(self._raw[name], name, self._mode,
                                                     self._missing, self._blank)
        return self._built[name]

    def __contains__(self, name) -> bool:
        return name in self._raw

    def __iter__(self):
        return iter(self._raw)

    def __len__(self):
        return len(self._raw)


class Pipeline:
    """Lazy model graph over a ``{SOURCE: DataFrame}`` dict of raw tables."""

    def __init__(self, raw: dict[str, DataFrame], config: PipelineConfig | None = None,
                 missing: str = "error"):
        self.raw = raw
        self.config = config or PipelineConfig()
        self.missing = missing
        self._shared: list[str] = []  # paths of models written once
        self.sightings: int | None = None  # rows of the observations, once these are written

    # cleaning layer (views)
    @cached_property
    def clean(self) -> "CleanModels":
        return CleanModels(self.raw, self.config.cast_mode, self.missing,
                           self.config.blank_id_to_null)

    # staging (views)
    @cached_property
    def observations(self) -> DataFrame:
        return observation_map(self.raw, self.config)

    @cached_property
    def timeline(self) -> DataFrame:
        if "observations" in self.__dict__ and self._shared:  # written once, for several readers
            return timeline.ownership_timeline(self.observations, self.config, self.sighting_tasks())
        # Only complete sightings matter to the timeline; this form pushes the
        # raw IS NOT NULL predicates into the scans.
        complete = observation_map(self.raw, self.config, complete_only=True)
        return timeline.ownership_timeline(complete, self.config)

    def sighting_tasks(self, rows_per_task: int = ROWS_PER_TASK) -> int | None:
        """The tasks that the written observations are dealt to (see ``ordered``)."""
        return None if self.sightings is None else tasks_for(self.observations.sparkSession, self.sightings, rows_per_task)

    @cached_property
    def spine(self) -> DataFrame:
        return spine.creator_spine(self.observations, self.config)

    # core (tables)
    @cached_property
    def handle_log(self) -> DataFrame:
        return timeline.handle_log(self.timeline)

    @cached_property
    def id_map(self) -> DataFrame:
        return idmap.external_id_map(self.clean["ECHO"], self.config.dedupe_id_map)

    @cached_property
    def email(self) -> DataFrame:
        return email_ops.email_dimension(self._email_inputs(), self.config)

    def _email_inputs(self) -> dict[str, DataFrame]:
        """Cleaned email sources, each built from raw rows whose id and email
        are not NULL. The email dimension drops rows with a NULL cleaned id
        or email anyway, and a NULL raw value always cleans to NULL, so the
        result is the same. The filter on raw columns, though, reaches the
        Parquet reader as a pushed predicate (row groups without such values
        are skipped); the cleaned-column filter cannot."""
        from pyspark.sql import functions as F

        out = {}
        for src, _tag, id_col, email_col, _c, _u in email_ops.EMAIL_SOURCES:
            if src in self.raw:
                raw = self.raw[src].filter(F.col(id_col).isNotNull() & F.col(email_col).isNotNull())
                out[src] = staging.clean_source(raw, src, self.config.cast_mode, self.missing,
                                                self.config.blank_id_to_null)
        return out

    def share(self, *targets: str) -> "Pipeline":
        """Write each model once that ``targets`` read more than once, directly
        or through others; a target's own reader counts as one. Readers built
        afterwards read the copy. Cleaning views are not written: they are one
        projection of their source. ``close`` removes the copies."""
        readers: Counter = Counter(targets)
        todo = list(dict.fromkeys(targets))
        for name in todo:
            for read in MODEL_READS.get(name, ()):
                readers[read] += 1
                if read not in todo:
                    todo.append(read)
        for name, attribute in SHAREABLE.items():  # in the order of their dependencies
            if readers[name] > 1 and attribute not in self.__dict__:
                self.__dict__[attribute] = materialize(getattr(self, attribute), name, self._shared)
                if attribute == "observations":
                    self.sightings = self.observations.count()  # of the copy: its footers are read
        return self

    def close(self) -> None:
        """Remove what ``share`` wrote; its readers are done with."""
        if self._shared:
            remove_written(SparkSession.active(), self._shared)
        for attribute in SHAREABLE.values():
            self.__dict__.pop(attribute, None)
        self.sightings = None

    def sql(self, text: str) -> DataFrame:
        """The rows of SQL ``text`` in which ``{model}`` names a model, e.g.
        ``select id_type, count(*) from {dim_creator_id_map} group by 1``. Only
        the models named are built."""
        names = {field for _, field, _, _ in Formatter().parse(text) if field}
        models = {name: self._model(name) for name in names}
        spark = next(iter(models.values())).sparkSession
        return spark.sql(text, **models)

    def core_tables(self) -> dict[str, DataFrame]:
        """The published (table) models."""
        return {"dim_creator_handle_log": self.handle_log, "dim_creator_id_map": self.id_map,
                "dim_creator_email": self.email}

    def quality_summary(self, tables: dict[str, DataFrame] | None = None) -> DataFrame:
        """Checks over the core tables: pass the published tables (``publish``
        returns them read back from storage); by default the lazy tables are
        used, and each check computes what it reads."""
        return quality.summary(tables if tables is not None else self.core_tables())

    def models(self) -> dict[str, DataFrame]:
        """Every model under its original name. All are lazy but the spine, whose
        summary of the sightings is written once here (three parts read it)."""
        out = {f"stg_{n.lower()}": df for n, df in self.clean.items()}
        out.update({"stg_tiktok_id_handle_map": self.observations,
                    "stg_tiktok_id_handle_map_time": self.timeline,
                    "stg_creator": self.spine})
        out.update(self.core_tables())
        return out

    def register_views(self, names=None) -> list[str]:
        """Expose models as temp views for SQL users (``spark.sql("select ..
        from dim_creator_email")``). By default the cleaned model of every
        given source; name other models explicitly (a missing input raises
        KeyError). Building the spine writes its summary once, at that moment."""
        done = []
        for name in names or ("stg_" + n.lower() for n in self.raw):
            df = self._model(name)
            df.createOrReplaceTempView(name)
            done.append(name)
        return done

    def _model(self, name: str) -> DataFrame:
        if name.startswith("stg_") and name[4:].upper() in self.raw:
            return self.clean[name[4:].upper()]
        return {"stg_tiktok_id_handle_map": lambda: self.observations,
                "stg_tiktok_id_handle_map_time": lambda: self.timeline,
                "stg_creator": lambda: self.spine,
                "dim_creator_handle_log": lambda: self.handle_log,
                "dim_creator_id_map": lambda: self.id_map,
                "dim_creator_email": lambda: self.email}[name]()

    def publish(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet") -> dict:
        """Write the three core tables (full rebuild) and return them read
        back from storage, so checks run on what was published."""
        schema = target_schema(self.config.env, MODEL_FOLDER["core"], self.config.base_schema)
        out = {}
        for name, df in self.core_tables().items():
            out[name] = write_table(spark, df, name, schema=schema, root=root, fmt=fmt)
        return out
