"""Query plans composed from the operators, the registry and the SQL oracle."""
