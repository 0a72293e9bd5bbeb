"""hearth: listing analytics as Spark DataFrame jobs.

Landed listing pages become a typed listing table (plus a reject table),
listings are screened by price and floor, galleries are kept as ordered
arrays, prompts are rendered per (listing, wish) request and scored in
one batch job through a pluggable model client.

Sub-packages:
  functions  column-expression helpers (text, numbers, codecs, images)
  sources    readers and writers (landed pages, regions, stage files)
  operators  DataFrame -> DataFrame operators (extract, screen, gallery, ...)
  plans      end-to-end jobs and the driver-table query catalog
  streaming  incremental landing of detail pages with Structured Streaming
"""

__version__ = "0.1.0"
