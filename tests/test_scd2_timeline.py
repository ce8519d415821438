"""Back-dated dimension changes against a timeline kept by hand."""

import datetime as dt
import random

from ledgerlake.operators import scd2

DIM = "game_sk long, game_key string, genre string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
UPDATES = "game_key string, at timestamp_ntz, recorded_at timestamp_ntz, genre string"


def at(day):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day)


def by_hand(dim, updates, until=60):
    """game -> genre of every day (None: no version), then its runs."""
    out = set()
    for game in {r[1] for r in dim} | {u[0] for u in updates}:
        points = {}  # day -> (rank, genre); an update outranks a version, a start an end
        for _, g, genre, start, end, _ in dim:
            if g == game:
                points[start] = max(points.get(start, ((), None)), ((0, 1), genre), key=lambda x: x[0])
                if end is not None:
                    points[end] = max(points.get(end, ((), None)), ((0, 0), None), key=lambda x: x[0])
        for g, day, recorded, genre in updates:
            if g == game and day is not None:
                points[day] = max(points.get(day, ((), None)), ((1, recorded, genre), genre), key=lambda x: x[0])
        runs, current = [], None
        for day in sorted(points):
            genre = points[day][1]
            if genre == current:
                continue
            if runs and runs[-1][2] is None:
                runs[-1][2] = day
            if genre is not None:
                runs.append([genre, day, None])
            current = genre
        out |= {(game, genre, start, end, end is None) for genre, start, end in runs}
    return out


def test_updates_in_any_order_equal_the_timeline(spark):
    draw = random.Random(5)
    for _ in range(6):
        dim, updates = [], []
        for game in "abc":
            day = draw.randrange(10)
            for _ in range(draw.randrange(3)):
                end = day + 1 + draw.randrange(12)
                dim.append((0, game, draw.choice("xyz"), at(day), at(end), False))
                day = end + draw.choice([0, 0, 4])
            if draw.random() < 0.7:
                dim.append((0, game, draw.choice("xyz"), at(day), None, True))
            for k in range(draw.randrange(8)):
                updates.append((game, at(draw.randrange(50)), at(100 + draw.randrange(6)), draw.choice("xyz")))
        updates += updates[:2] + [("a", None, at(0), "x")]
        frame = spark.createDataFrame(dim, DIM)
        want = by_hand(dim, updates)
        orders = [updates, updates[::-1], draw.sample(updates, len(updates))]
        for order in orders:
            timeline = scd2.scd2_timeline(frame, tracked=["genre"])
            cut = draw.randrange(len(order) + 1)
            for batch in (order[:cut], order[cut:], order[:2]):
                timeline = scd2.scd2_record(timeline, spark.createDataFrame(batch, UPDATES), tracked=["genre"])
            got = scd2.scd2_of_timeline(timeline, tracked=["genre"])
            assert {(r["game_key"], r["genre"], r["valid_from"], r["valid_to"], r["is_current"]) for r in got.collect()} == want
        whole = scd2.scd2_backdated(frame, spark.createDataFrame(updates, UPDATES), tracked=["genre"])
        assert whole.count() == len(want)
