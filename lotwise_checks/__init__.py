"""Sample events over the test tables, and the SQL the queries are compared with."""
