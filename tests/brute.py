"""What the plans should give, row by row in plain Python, for small inputs."""

import math
import random
import re
from collections import defaultdict

MARKER = "(no genres listed)"


def make_movies(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    titles = ["Alpha (1984)", "Beta (1999)", "(1984) Gamma (2001)", "No Year", "Delta (199)", None, 'Say "Hi, You" (2014)']
    genres = ["A", "A|B", "B|C|D", MARKER, None, "", "A|", "A|A", f"B|{MARKER}", ' Friend"" (2014)"']
    ids = [None, *range(25)]
    return [(rng.choice(ids), rng.choice(titles), rng.choice(genres)) for _ in range(n)]


def make_ratings(seed: int, n: int = 400, hot: int = 3) -> list[tuple]:
    """About a third of the ratings, and many equal copies, fall on one film."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        movie = hot if rng.random() < 0.35 else rng.choice([None, *range(30)])
        rows.append(
            (
                rng.choice([None, 1, 2, 3, 4, 5]),
                movie,
                rng.choice([None, 0.0, -1.0, 0.5, 3.0, 4.5, 5.0, float("nan")] + [2.0, 2.5, 3.5] * 3),
                rng.choice([None, 0, 1_000_000_000, 1_636_266_600]),
            )
        )
    return rows


def _or_low(value):
    return (value is not None, value if value is not None else "")


def films(movies):
    kept = {}
    for movie_id, title, genres in movies:
        key = (_or_low(title), _or_low(genres))
        if movie_id not in kept or key > kept[movie_id][0]:
            kept[movie_id] = (key, title, genres)
    return [(movie_id, title, genres) for movie_id, (_, title, genres) in kept.items()]


def year_of(title):
    found = re.search(r"\((\d{4})\)", title or "")
    return int(found.group(1)) if found else None


def movies_silver(movies):
    rows = []
    for movie_id, title, genres in films(movies):
        if genres is None:
            continue
        for genre in genres.split("|"):
            rows.append((movie_id, title, year_of(title), None if genre == MARKER else genre))
    return rows


def ratings_silver(ratings):
    return [(u, m, None if r is None or r <= 0 else r, t) for u, m, r, t in ratings]


def is_complete(row):
    return all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in row)


def gold(movies, ratings, drop_nulls):
    """``movieId, userId, rating, epoch, title, year, genre`` in either variant."""
    movie_rows, rating_rows = movies_silver(movies), ratings_silver(ratings)
    if drop_nulls:
        movie_rows, rating_rows = filter(is_complete, movie_rows), filter(is_complete, rating_rows)
    of_film = defaultdict(list)
    for movie_id, title, year, genre in movie_rows:
        of_film[movie_id].append((title, year, genre))
    return [
        (m, u, r, t, title, year, genre)
        for u, m, r, t in rating_rows
        if m is not None
        for title, year, genre in of_film[m]
    ]


def totals(gold_rows, column):
    """Per value of a column: rows, rated rows, sum of ratings (NULL if none is rated)."""
    groups = defaultdict(list)
    for row in gold_rows:
        groups[row[column]].append(row[2])
    result = {}
    for key, ratings in groups.items():
        rated = [r for r in ratings if r is not None]
        result[key] = (len(ratings), len(rated), sum(rated) if rated else None)
    return result


def comparable(rows):
    """Sorted, with NaN equal to itself."""
    return sorted((tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows), key=repr)
