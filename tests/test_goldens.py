"""Published results, replayed from a folder that the user names.

``TASTEGRID_GOLDENS`` holds ``users.txt`` (pipe-separated profiles) and the
results ``young.csv`` (under 20), ``group.csv`` (scientists of 30 to 40) and
``favourites.csv`` (user, favourite category, count), each with a header.
"""

import csv
import os
from collections import Counter

import pytest

from tastegrid import sources
from tastegrid.operators import cohorts

FOLDER = os.environ.get("TASTEGRID_GOLDENS", "")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no published results")


def published(name):
    with open(f"{FOLDER}/{name}", newline="") as file:
        return list(csv.DictReader(file))


@pytest.fixture
def users(spark):
    return sources.read_users(spark, f"{FOLDER}/users.txt")


@pytest.mark.parametrize("name", ["young.csv", "group.csv"])
def test_cohorts_are_the_published_ones(users, name):
    found = cohorts.users_below(users, 20) if name == "young.csv" else cohorts.users_of_group(users, "scientist", 30, 40)
    fields = ("user_id", "age", "gender", "occupation", "zip_code")
    got = {tuple(str(row[field]) for field in fields) for row in found.collect()}
    assert got == {tuple(row[field].strip() for field in fields) for row in published(name)}


def test_favourites_have_the_published_distribution():
    counts = Counter(row["favorite_genre"] for row in published("favourites.csv"))
    assert sum(counts.values()) == 568 and counts.most_common(2) == [("Drama", 371), ("Comedy", 103)]
