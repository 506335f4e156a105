"""Compositions of operators: the star-schema job (``star``), feeds
(``feeds``, ``world``, ``series_plan``), driver-table adapters
(``testviews``, ``geodocs``) and the registry of named queries
(``registry``, ``queries``).
"""
