"""Small hand-made feeds, and the marts computed from them in plain Python with fractions."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from spendweave.sources.specs import FACEBOOK, GOOGLE, TIKTOK

DAY = date(2024, 1, 1)


def cents(value) -> Decimal:
    return Decimal(value).quantize(Decimal("0.01"))


def half_up(num, den, places):
    """Exact quotient rounded once, half away from zero."""
    if num is None or not den:
        return None
    scaled = Fraction(num) / Fraction(den) * 10**places
    units = int(abs(scaled) + Fraction(1, 2)) * (1 if scaled >= 0 else -1)
    return (Decimal(units) / Decimal(10**places)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def facebook_row(day=DAY, campaign="c1", name=None, group="g1", impressions=100, clicks=10, spend="5.00", conversions=2, views=50):
    return (
        day, campaign, name or f"N_{campaign}", group, f"N_{group}", impressions, clicks, cents(spend), conversions,
        views, Decimal("0.0123"), 90, Decimal("1.20"),
    )


def google_row(
    day=DAY, campaign="c1", name=None, group="g1", impressions=100, clicks=10, cost="5.00", conversions=2,
    value="20.00", quality=7, share="0.50", group_name=None,
):
    return (
        day, campaign, name or f"N_{campaign}", group, group_name or f"N_{group}", impressions, clicks, cents(cost),
        conversions, cents(value), Decimal("0.1000"), Decimal("0.50"), quality,
        None if share is None else Decimal(share),
    )


def tiktok_row(
    day=DAY, campaign="c1", name=None, group="g1", impressions=100, clicks=10, cost="5.00", conversions=2,
    views=80, watched=(60, 40, 20, 10), likes=3, shares=2, comments=1,
):
    return (
        day, campaign, name or f"N_{campaign}", group, f"N_{group}", impressions, clicks, cents(cost), conversions,
        views, *watched, likes, shares, comments,
    )


def frames(spark, facebook=(), google=(), tiktok=()):
    rows = ((facebook, FACEBOOK), (google, GOOGLE), (tiktok, TIKTOK))
    return tuple(spark.createDataFrame(list(r), spec.schema()) for r, spec in rows)


def random_feeds(seed=7, rows=120):
    """Rows with zero denominators, NULL measures and keys, refunds, repeated keys and a hot campaign."""
    rng = random.Random(seed)

    def common():
        hot = rng.random() < 0.35
        return dict(
            day=DAY + timedelta(days=rng.randrange(40)),
            campaign="hot" if hot else f"c{rng.randrange(8)}",
            group=f"g{rng.randrange(5)}",
            impressions=rng.choice([0, None, rng.randrange(1, 5000), rng.randrange(1, 5000)]),
            clicks=rng.choice([0, rng.randrange(1, 300), rng.randrange(1, 300)]),
            conversions=rng.choice([0, 0, rng.randrange(1, 40)]),
        )

    def amount():
        return f"{rng.randrange(-500, 90000) / 100:.2f}"

    facebook = [facebook_row(**common(), spend=amount(), views=rng.choice([None, 10, 70])) for _ in range(rows)]
    google = [
        google_row(
            **common(), cost=amount(), value=amount(), quality=rng.choice([None, 5, 6, 9]),
            share=rng.choice([None, "0.31", "0.75"]), name=rng.choice([None, None, "Shared"]),
        )
        for _ in range(rows)
    ]
    tiktok = [tiktok_row(**common(), cost=amount(), views=rng.choice([0, 9, 80])) for _ in range(rows)]
    # a NULL key is a group of its own
    google.append(google_row()[:2] + (None,) + google_row()[3:])
    return facebook, google, tiktok


COMMON = "date campaign_id campaign_name ad_group_id ad_group_name impressions clicks spend conversions".split()


def facts(facebook=(), google=(), tiktok=()):
    """The unified rows as dicts."""
    out = []
    for rows, spec in ((facebook, FACEBOOK), (google, GOOGLE), (tiktok, TIKTOK)):
        for row in rows:
            raw = dict(zip(spec.columns, row))
            out.append(
                defaultdict(
                    lambda: None,
                    {unified: raw[source] for unified, source in spec.provides.items()},
                    platform=spec.platform,
                )
            )
    return out


def total(rows, measure):
    values = [r[measure] for r in rows if r[measure] is not None]
    return sum(values) if values else None


def grouped(rows, *keys):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in keys)].append(r)
    return groups


def kpis(rows, prefix="avg_"):
    imp, clk, spd, cnv = [total(rows, m) for m in ("impressions", "clicks", "spend", "conversions")]
    return {
        f"{prefix}ctr": half_up(clk, imp, 4),
        f"{prefix}cpc": half_up(spd, clk, 2),
        f"{prefix}cpa": half_up(spd, cnv, 2),
        f"{prefix}conversion_rate": half_up(cnv, clk, 4),
        f"{prefix}cpm": half_up(None if spd is None else spd * 1000, imp, 2),
    }


def distinct(rows, key):
    return len({r[key] for r in rows if r[key] is not None})


def rank(values, best_first):
    """1 + number of strictly better ones; None last."""
    known = [v for v in values if v is not None]
    return [
        len(known) + 1 if v is None else 1 + sum(1 for o in known if (o > v if best_first else o < v)) for v in values
    ]


def week(day):
    return None if day is None else day - timedelta(days=day.weekday())


def rows_of(df, *columns):
    """Collected rows as a sorted list of tuples, DECIMALs normalised."""
    names = columns or df.columns

    def plain(v):
        return v.normalize() + 0 if isinstance(v, Decimal) else v

    return sorted([tuple(plain(r[c]) for c in names) for r in df.collect()], key=repr)


def as_rows(dicts, columns):
    def plain(v):
        return v.normalize() + 0 if isinstance(v, Decimal) else v

    return sorted([tuple(plain(d[c]) for c in columns) for d in dicts], key=repr)
