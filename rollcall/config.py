"""Run parameters.

Everything the reference hard-codes (mail domains, excluded sites and
students, the as-of date, the graduation base year, the batch size) is a
field here, so a job is a pure function of (tables, config).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# Grade labels that select section groups, secondary-school
# grades (period in the address, portal eligibility) and elementary grades
# (course name in the description).
SECTION_GRADES = ("TK", "K", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12")
SECONDARY_GRADES = ("6", "7", "8", "9", "10", "11", "12")
ELEMENTARY_GRADES = ("TK", "K", "1", "2", "3", "4", "5")

# Group types and member roles of the directory.
SECTION_GROUP = "StudentSection"
COHORT_GROUP = "StuSchoolYOG"
SCHOOL_GROUP = "SchoolConference"
COURSE_GROUP = "Courses"
ROLE_MEMBER = "MEMBER"
ROLE_OWNER = "OWNER"


@dataclass(frozen=True)
class SyncConfig:
    as_of: date
    academic_year: int
    staff_domain: str = "example.org"
    student_domain: str = "students.example.org"
    group_domain: str = "groups.example.org"
    staff_ou: str = "/Staff"
    excluded_sites: tuple[int, ...] = ()
    excluded_students: tuple[int, ...] = ()
    cohort_base_year: int = 2030
    cohort_min_upper_unit: int = 5
    cohort_min_grade: int = 6
    course_group_numbers: tuple[str, ...] = ()
    batch_size: int = 20
    # The reference sums status + suspend flag; False applies the fix.
    legacy_suspend_rule: bool = False
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        if self.cohort_min_grade < 0:
            raise ValueError("cohort_min_grade must not be negative")
        for name in ("staff_domain", "student_domain", "group_domain"):
            if "@" in getattr(self, name) or not getattr(self, name):
                raise ValueError(f"{name} must be a bare domain")

    @property
    def year_tag(self) -> str:
        """'0001' for academic year 2001 (address suffix)."""
        y = self.academic_year
        return f"{(y - 1) % 100:02d}{y % 100:02d}"

    @property
    def year_label(self) -> str:
        """'00/01' for academic year 2001 (display-name suffix)."""
        y = self.academic_year
        return f"{(y - 1) % 100:02d}/{y % 100:02d}"
