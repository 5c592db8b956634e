"""The list of registered queries: name -> callable(spark, sf_dir), and the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalair.operators import spatial
from vitalair.plans import views

_QUERIES, _SQL = {}, {}


def query(sql: str | None, day: str = ""):
    """Register a query; the column named by day is given as yyyy-MM-dd text, as days are in this library's outputs.

    sql is None where SQL cannot express the result.
    """

    def add(f):
        text = f"WITH {views.SQL.strip()} {sql}"
        _QUERIES[f.__name__] = (lambda spark, sf: f(spark, sf).withColumn(day, F.col(day).cast("string"))) if day else f
        if sql is not None:
            _SQL[f.__name__] = f"SELECT * REPLACE ({day}::DATE::VARCHAR AS {day}) FROM ({text})" if day else text
        return f

    return add


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)


def r(c, digits: int = 6):
    return F.round(c, digits)


def grid_sql() -> str:
    """SQL of patients' projected places and grid cells of the 12 km grid: xy(patient_num, rho, th) and g(patient_num, col, row)."""
    _n, _f, _rho0 = spatial._constants()
    return f"""xy AS (SELECT patient_num, {spatial.A * _f!r}*pow(tan(pi()/4-radians(lat)/2)/pow((1-{spatial.E!r}*sin(radians(lat)))/(1+{spatial.E!r}*sin(radians(lat))),{spatial.E / 2!r}),{_n!r}) AS rho, radians(lon+97)*{_n!r} AS th FROM patients),
g AS (SELECT patient_num, floor((rho*sin(th)+2556000)/12000)::INT+1 AS col, floor(({_rho0!r}-rho*cos(th)+1728000)/12000)::INT+1 AS row FROM xy)"""
