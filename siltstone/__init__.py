"""Layered (raw -> preparation -> model -> mart) analytics jobs on PySpark."""
