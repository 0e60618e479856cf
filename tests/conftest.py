"""Shared session and small input builders."""

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybrook.schemas import CATEGORY_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, text_schema  # noqa: E402
from daybrook.session import local_session  # noqa: E402

D1, D2, D3 = "20220916", "20220917", "20220918"
T0 = 1663322400
DAY1 = dt.date(2022, 9, 16)

# fixed values: one well-formed raw row
BASE = dict(
    user_id="1", pid="100", author_id="900", category_id="1", category_level="1", parent_id="1", root_id="1",
    exposed_time=str(T0), author_fans_count="500", watch_time="10", duration="20.0", cvm_like="False", click="False",
    comment="False", follow="False", collect="False", forward="False", hate="False", tag_name="tag-a", title="a title",
    p_hour="10", p_date=D1, gender="M", age="30", mod_price="1999", fre_city="Beijing", fre_community_type="城区",
    fre_city_level="一线城市",
)


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "tests", shuffle_partitions=2, memory="4g")
    yield s
    s.stop()


def raw_row(**changes):
    return {**BASE, **{k: str(v) for k, v in changes.items()}}


def raw_df(spark, rows):
    return spark.createDataFrame([[r[c] for c in RAW_COLUMNS] for r in rows], RAW_SCHEMA)


NOON, MINUTE, DAY = T0 + 7200, 60, 86400


def two_days():
    """First day: one event under two tags, an event delivered twice, a rewatched one, one with unknown places (six rows).

    Second day: the first event again, and two new ones (three rows).
    """
    cook = dict(user_id=11, pid=300, title="noodles", exposed_time=NOON, watch_time=25, duration="40.5", p_hour=12, gender="F", age=33)
    night = dict(user_id=12, pid=301, title="owls", exposed_time=NOON - 9 * 3600, watch_time=8, duration="64.0", p_hour=3, age=19)
    replay = dict(user_id=13, pid=302, title="goal!", exposed_time=NOON + 5 * MINUTE, watch_time=95, duration="31.5", p_hour=12, age=27)
    nowhere = dict(user_id=14, pid=303, title="maps", fre_community_type="unknown", fre_city_level="unknown", exposed_time=NOON + MINUTE, p_hour=12)
    return [
        raw_row(**cook, category_id=2, tag_name="wok"), raw_row(**cook, category_id=3, tag_name="soup"),
        raw_row(**night), raw_row(**night), raw_row(**replay, hate="True"), raw_row(**nowhere),
        raw_row(**{**cook, "category_id": 2, "tag_name": "wok", "p_date": D2}),
        raw_row(**{**night, "pid": 304, "title": "foxes", "exposed_time": NOON + DAY, "p_hour": 12, "p_date": D2}),
        raw_row(**{**replay, "exposed_time": NOON + DAY + MINUTE, "watch_time": 30, "p_date": D2}),
    ]


def lookup_df(spark, rows=None):
    rows = rows or [("1", "1", "旅行", "1", "1", " travel"), ("1", "2", "手工", "2", "2", " crafts"),
                    ("2", "3", "摄影", "1", "1", " photo")]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(
        f"{c} string" for c in CATEGORY_COLUMNS) + ", _file_seq bigint")


def files_df(spark, files=(("300.txt", "first boil the water then"), ("301.txt", "hoot"), ("readme.txt", "about these files"))):
    return spark.createDataFrame(list(files), text_schema(["file_name", "value"]))


def events_df(spark, rows):
    """(user, time, watch, hour[, hate, rewatch]) tuples as minimal events of one date."""
    full = [(u, 1000 + i, t, w, h, DAY1, *(rest or [False, False]))
            for i, (u, t, w, h, *rest) in enumerate(rows)]
    return spark.createDataFrame(full, "user_id bigint, pid bigint, exposed_time bigint, watch_time bigint, p_hour bigint, "
                                       "p_date date, hate boolean, is_rewatch_flagged boolean")
