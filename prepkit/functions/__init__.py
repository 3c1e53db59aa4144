"""Column expressions, name rules and type predicates shared by the operators."""
