"""Stage graph, registered queries and the report job."""
