"""Column layouts and the category vocabulary shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- Fixed values: application names, category labels and calendar limits ---------------


@dataclass(frozen=True)
class Category:
    """One content category: stored label, English label, wide-column suffix, member apps."""

    label: str
    english: str
    suffix: str
    description: str
    apps: tuple[str, ...]


CATEGORIES = (
    Category("Truyền Hình", "TV", "TruyenHinh", "Live television channels",
             ("CHANNEL", "DSHD", "KPLUS", "KPlus")),
    Category("Phim Truyện", "Movie", "PhimTruyen", "Films and series on demand",
             ("VOD", "FIMS_RES", "BHD_RES", "VOD_RES", "FIMS", "BHD", "DANET")),
    Category("Giải Trí", "Entertainment", "GiaiTri", "Light entertainment", ("RELAX",)),
    Category("Thiếu Nhi", "Kids", "ThieuNhi", "Programmes for children", ("CHILD",)),
    Category("Thể Thao", "Sports", "TheThao", "Sports programmes", ("SPORT",)),
)
UNKNOWN = Category("Error", "Unknown", "Error", "Application not in the catalogue", ())
ALL_CATEGORIES = (*CATEGORIES, UNKNOWN)

KNOWN_APPS = tuple(app for category in CATEGORIES for app in category.apps)
OTHER_APP = "(other)"

CALENDAR_START = "2020-01-01"
CALENDAR_END = "2030-12-31"
CALENDAR = (CALENDAR_START, CALENDAR_END)  # what loads use unless told otherwise

# Exclusive upper limits of the two lower activation levels, and the level names.
SPAN_LIMITS = (10, 20)
SPAN_LEVELS = ("Low", "Medium", "High")
SINCE_FIRST_LIMITS = (3, 10)
SINCE_FIRST_LEVELS = ("Thấp", "Trung bình", "Cao")

# --- End of fixed values -----------------------------------------------------------------


def label_of(category: Category, labels: str = "vi") -> str:
    if labels not in ("vi", "en"):
        raise ValueError(f"labels must be 'vi' or 'en', not {labels!r}")
    return category.label if labels == "vi" else category.english


def category_labels(labels: str = "vi", with_unknown: bool = True) -> list[str]:
    chosen = ALL_CATEGORIES if with_unknown else CATEGORIES
    return [label_of(category, labels) for category in chosen]


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "binary": T.BinaryType(),
}


def columns(**kinds: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in kinds.items()])


# Seconds are read as text: a number, quoted or with a fraction, would not fit a column of whole numbers.
SOURCE = columns(Contract="string", Mac="string", AppName="string",
                 TotalDuration="string", Date="string")
RAW = T.StructType([T.StructField("_source", SOURCE)])

STAGING = columns(Contract="string", Mac="string", AppName="string",
                  TotalDuration="bigint", EventDate="date")

# Landing lines that gave no record.
REJECTED = columns(SourceFile="string", Line="string", Reason="string")

SESSION_GRAIN = columns(EventDate="date", Contract="string", Mac="string", AppName="string",
                        TotalDuration="bigint", SessionCount="bigint")

SEEN_PAIRS = columns(Contract="string", Mac="string")
OWNED_PAIRS = columns(Contract="string", Mac="string", ContractKey="bigint")

# One row per change: the newest run of a contract says which date is its first; NULL: it has none left.
# ChangeRun is the run of the change where another run has folded it, else NULL.
FIRST_DATE = columns(ContractKey="bigint", FirstDateKey="int", WasDateKey="int", ChangeRun="int")

DIM_CONTRACT = columns(ContractKey="bigint", ContractID="string")
DIM_DEVICE = columns(DeviceKey="bigint", MacAddress="string", ContractKey="bigint")

FACT_VIEWING_SESSION = columns(
    DateKey="int", ContractKey="bigint", DeviceKey="bigint", AppKey="int",
    ContentTypeKey="int", TotalDuration="bigint", SessionCount="bigint")

_SUMMARY_SUMS = {f"TotalDuration_{c.suffix}": "bigint" for c in ALL_CATEGORIES}
FACT_CONTRACT_SUMMARY = columns(
    DateKey="int", ContractKey="bigint", TotalDevices="bigint",
    **_SUMMARY_SUMS, TotalDuration_All="bigint")

_MART_SUMS = {f"Duration_{c.suffix}": "bigint" for c in ALL_CATEGORIES}
DM_CONTRACT_ANALYTICS = columns(
    DateValue="date", Year="int", Quarter="int", Month="int", MonthName="string", Day="int",
    ContractID="string", TotalDevices="bigint", **_MART_SUMS, Duration_Total="bigint",
    MostWatchContentType="string", MostWatchDuration="bigint",
    ActivationDays="int", ActivationLevel="string")

_DAILY_SUMS = {f"TotalDuration_{c.suffix}": "bigint" for c in CATEGORIES}
DM_DAILY_SUMMARY = columns(
    DateValue="date", Year="int", Month="int", Day="int",
    TotalContracts="bigint", TotalDevices="bigint", **_DAILY_SUMS, TotalDuration_All="bigint")

DM_CONTENT_TYPE_TREND = columns(
    DateValue="date", Year="int", Month="int", ContentType="string",
    TotalDuration="bigint", TotalSessions="bigint", UniqueContracts="bigint")

MEDIA_REPORT = columns(ReportDate="date", AppName="string",
                       TotalDuration="bigint", TotalAccess="bigint")

# Rollups: rows of a contract over a week or month, and the contracts active in a period as bitmaps of their keys.
ROLLUP_CONTRACT = columns(
    PeriodStart="date", ContractID="string", TotalDevices="bigint", **_MART_SUMS, Duration_Total="bigint",
    MostWatchContentType="string", MostWatchDuration="bigint", ActivationDays="int", ActivationLevel="string")
ROLLUP_LEVELS = T.StructType([T.StructField("Level", T.StringType()), *ROLLUP_CONTRACT])
ROLLUP_ACTIVE = columns(
    PeriodStart="date", ContentType="string", Bucket="bigint", Contracts="binary",
    TotalDuration="bigint", TotalSessions="bigint")
