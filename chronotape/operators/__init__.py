"""DataFrame operators: joins, aggregations, ordered scans and audits."""
