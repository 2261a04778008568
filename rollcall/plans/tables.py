"""Domain tables: what the plans and ``jobs.nightly_run`` read, by name.

:class:`DomainTables` derives the stage tables that the extract jobs write (staff, students, sections, schedule) and the normalised
accounts from the source tables, and bundles the sources of the larger extracts.  Where the source tables come from is up to its
subclasses: :class:`CatalogTables` reads each from a parquet path or a catalog table name; every one must be provided, nothing is
invented.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from rollcall.config import SyncConfig
from rollcall.plans import accounts, extract


class DomainTables:
    """Tables as attributes, built when they are asked for and kept."""

    def __init__(self, spark: SparkSession, config: SyncConfig):
        self.spark, self.cfg = spark, config
        self._cache: dict[str, DataFrame] = {}

    def _build(self, name: str) -> DataFrame | None:
        builder = getattr(type(self), f"_v_{name}", None)
        return builder(self) if builder is not None else None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            found = self._build(name)
            if found is None:
                raise AttributeError(name)
            self._cache[name] = found
        return self._cache[name]

    # -- stage tables and normalised current state
    def _v_staff_stage(self) -> DataFrame:
        return accounts.staff_stage(extract.staff_extract(self.sis_users))

    def _v_students_stage(self) -> DataFrame:
        return extract.student_extract(self.student_sources(), self.cfg)

    def _v_accounts(self) -> DataFrame:
        return accounts.normalise_accounts(self.account)

    def _v_sections(self) -> DataFrame:
        return extract.section_groups(self.section_sources(), self.cfg)

    def _v_schedule(self) -> DataFrame:
        return extract.student_schedule(dict(terms=self.terms, sessions=self.sessions, section_term=self.section_term,
                                             section_student=self.section_student), self.cfg)

    # -- bundles for the plans
    def section_sources(self) -> dict[str, DataFrame]:
        return dict(section_teacher=self.section_teacher, section_term=self.section_term, terms=self.terms,
                    sessions=self.sessions, sites=self.sis_sites, grade_levels=self.grade_levels,
                    section_course=self.section_course, courses=self.courses,
                    section_timeblock=self.section_timeblock, timeblocks=self.timeblocks,
                    users=self.sis_users, site_labels=self.site_labels)

    def student_sources(self) -> dict[str, DataFrame]:
        return dict(students=self.sis_students, enrol=self.enrol, sessions=self.sessions,
                    sites=self.sis_sites, custom_fields=self.student_cf, grade_levels=self.grade_levels,
                    houses=self.student_house)


class CatalogTables(DomainTables):
    """Tables provided by the user: name → parquet path or catalog table."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, str], config: SyncConfig):
        super().__init__(spark, config)
        self.tables = dict(tables)

    def _build(self, name: str) -> DataFrame:
        if name in self.tables:
            src = self.tables[name]
            return self.spark.read.parquet(src) if "/" in src or src.endswith(".parquet") else self.spark.table(src)
        found = super()._build(name)
        if found is None:
            raise AttributeError(f"table {name!r} was not provided")
        return found
