"""DataFrame operators: select, paging, rollup, intervals, spatial, catalog and alert work."""
