"""The registered queries: each a Spark plan over the tables, with the SQL that states its answer."""
