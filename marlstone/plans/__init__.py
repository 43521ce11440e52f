"""Plans: read models made of operators, and the registered queries."""
