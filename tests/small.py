"""A small source for the jobs: a seed and four days, with people who come back."""

from __future__ import annotations

import datetime as dt

from mercata.plans.generator import Plan
from mercata.schemas import INPUT_COLUMNS, INPUT_DDL

FIRST = dt.date(2020, 3, 1)
# Higher shares than usual, so that few rows already show every case.
PLAN = Plan(
    first_day=FIRST, last_day=FIRST + dt.timedelta(days=3),
    resend=0.5, timestamp=0.2, status=0.2, price=0.4, review=0.4, payment=0.2,
)
SEED_DAYS, PER_DAY = 4, 12
STATUSES = ("delivered", "delivered", "shipped", "canceled", "delivered", "unavailable")
TYPES = ("credit_card", "boleto", "voucher")


def _stamp(day: dt.date, hours: int = 0) -> str:
    return (dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hours)).strftime("%Y-%m-%d %H:%M:%S")


def rows() -> dict[str, list[tuple]]:
    out = {name: [] for name in INPUT_COLUMNS}
    k = 0
    for offset in range(-SEED_DAYS, 4):
        day = FIRST + dt.timedelta(days=offset)
        for n in range(PER_DAY):
            k += 1
            status = STATUSES[k % len(STATUSES)]
            bought, due = _stamp(day, n), _stamp(day + dt.timedelta(days=10))
            arrived = _stamp(day + dt.timedelta(days=k * 5 % 19), 13) if status == "delivered" else None
            out["orders"].append((f"o{k}", f"c{k}", status, bought, bought, None, arrived, due))
            out["customers"].append((f"c{k}", f"person{k % 50}", "01001", f" City{k % 4} ", f"s{k % 3}"))
            for i in range(1, 2 + k % 3):
                out["order_items"].append(
                    (f"o{k}", str(i), f"p{(k + i) % 9}", f"v{(k * i) % 5}", due, f"{10 + k * 7 % 190}.50", f"{i}.25")
                )
            for i in range(1, 2 + k % 2):
                out["order_payments"].append((f"o{k}", str(i), TYPES[(k + i) % 3], str(1 + k % 4), f"{20 * i}.00"))
            if k % 5:
                out["order_reviews"].append((f"r{k}", f"o{k}", str(1 + k % 5), None, "well,\n\"ok\"", due, due))
    for p in range(8):
        out["products"].append((f"p{p}", f"cat{p % 3}" if p else None, "9.0", "9.0", "1.0", "100.0", "2.0", "3.0", "4.0"))
    out["sellers"] = [(f"v{s}", "01001", "town", f"S{s % 3}") for s in range(6)]
    out["category_translation"] = [("cat0", "First"), ("cat1", "Second")]
    return out


def source(spark) -> dict:
    return {name: spark.createDataFrame(r, INPUT_DDL[name]) for name, r in rows().items()}
