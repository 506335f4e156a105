"""DataFrame -> DataFrame operators.

``cleaning`` projections, defaults, filters; ``aggregate`` sums, counts,
bounds; ``reshape`` unpivots; ``joins``; ``dimensions`` date/geography
dimensions, span and surrogate ids; ``facts`` the case-fact pipeline;
``series`` per-entity windows; ``measures`` report measures; ``checks``
data-quality checks.
"""
