"""Column expressions shared by the loads and the reports. All stay inside Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and bounds that reports and dimensions must show exactly so.
NO_DISCOUNT = "Sem Desconto"
DISCOUNT_BANDS = ((10, "1-10%"), (20, "11-20%"), (30, "21-30%"))
HIGHEST_DISCOUNT = "Acima de 30%"
ABC_CLASSES = ((80, "A - Alto Valor"), (95, "B - Médio Valor"))
LAST_ABC_CLASS = "C - Baixo Valor"
CUSTOMER_CLASSES = ((50000, "VIP"), (20000, "Premium"), (5000, "Regular"))
LAST_CUSTOMER_CLASS = "Basico"
CONTINENTS = (("America", "Américas"), ("Europe", "Europa"), ("Pacific", "Ásia-Pacífico"))
OTHER_CONTINENT = "Outros"
PERSON, COMPANY, NEITHER = "Pessoa Física", "Empresa", "Indefinido"

# Weekday names in the order a working week runs; reports sort by it.
WEEK_ORDER = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Room for sums up to 10^20, and still 14 digits after the point in a quotient of two.
_SUM = "decimal(24,4)"


def money(total: Column) -> Column:
    """A sum rounded to cents, half away from zero."""
    return F.round(total, 2).cast("decimal(20,2)")


def quotient(num: Column, den: Column) -> Column:
    """Exact decimal quotient; NULL where the divisor is 0."""
    return num.cast(_SUM) / F.nullif(den.cast(_SUM), F.lit(0).cast(_SUM))


def percent(num: Column, den: Column) -> Column:
    return F.round(quotient(num, den) * 100, 2).cast("decimal(18,2)")


def per(num: Column, den: Column) -> Column:
    return F.round(quotient(num, den), 2).cast("decimal(18,2)")


def mean(c: str) -> Column:
    """Average of a decimal column rounded once, from its exact sum and its count of values."""
    return per(F.sum(c), F.count(c))


def date_key(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_week(day: Column) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(day) - 1


def full_name(first: Column, last: Column, label: str, key: Column) -> Column:
    """First and last name; the label and the key where either is missing."""
    return F.coalesce(F.concat(first, F.lit(" "), last), F.concat(F.lit(label), key.cast("string")))


def continent(group: Column) -> Column:
    (america, first), (europe, second), (pacific, third) = CONTINENTS
    return (
        F.when(group.like(f"%{america}%"), first)
        .when(group.like(f"%{europe}%"), second)
        .when(group.like(f"%{pacific}%"), third)
        .otherwise(OTHER_CONTINENT)
    )


def customer_type(person: Column, store: Column) -> Column:
    return F.when(person.isNotNull(), PERSON).when(store.isNotNull(), COMPANY).otherwise(NEITHER)


def seller_code(key: Column) -> Column:
    return F.concat(F.lit("V"), F.lpad(key.cast("string"), 5, "0"))


def list_margin(price: Column, cost: Column) -> Column:
    """Percentage of the list price that is not cost; 0 for an article without a price."""
    price = F.coalesce(price.cast("decimal(15,4)"), F.lit(0))
    cost = F.coalesce(cost.cast("decimal(15,4)"), F.lit(0))
    zero = F.lit(0).cast("decimal(5,2)")
    return F.when(price > 0, (quotient(price - cost, price) * 100).cast("decimal(5,2)")).otherwise(zero)


def discount_band(pct: Column) -> Column:
    """Upper bounds belong to the band; a missing discount falls through to the last one."""
    (low, first), (middle, second), (high, third) = DISCOUNT_BANDS
    return (
        F.when(pct == 0, NO_DISCOUNT)
        .when(pct <= low, first)
        .when(pct <= middle, second)
        .when(pct <= high, third)
        .otherwise(HIGHEST_DISCOUNT)
    )


def abc_class(cumulative_pct: Column) -> Column:
    (high, first), (middle, second) = ABC_CLASSES
    return F.when(cumulative_pct <= high, first).when(cumulative_pct <= middle, second).otherwise(LAST_ABC_CLASS)


def customer_class(revenue_each: Column) -> Column:
    (most, first), (more, second), (some, third) = CUSTOMER_CLASSES
    return (
        F.when(revenue_each >= most, first)
        .when(revenue_each >= more, second)
        .when(revenue_each >= some, third)
        .otherwise(LAST_CUSTOMER_CLASS)
    )


def week_position(name: Column) -> Column:
    """1 for Monday .. 7 for Sunday, NULL for any other text."""
    names = F.array(*[F.lit(n) for n in WEEK_ORDER])
    return F.nullif(F.array_position(names, name), F.lit(0))
