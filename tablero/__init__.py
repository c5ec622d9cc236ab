"""tablero — rental-marketplace reporting on Spark DataFrames.

Layers:
  functions/  Column -> Column helpers (local time, calendar boundaries, names, flags)
  operators/  DataFrame -> DataFrame building blocks (latest per key, transitions,
              role slots, ordered lists, ancestor roll-ups, populations)
  sources/    table schemas, catalog loading, driver-table stand-ins, sinks
  plans/      the twelve reports and the operator stand-in queries
  llm/        operators for large training-data corpora (optional)
"""

DEFAULT_TZ = "America/Mexico_City"

__all__ = ["DEFAULT_TZ"]
