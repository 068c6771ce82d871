"""Column builders from built-in functions. Those over arrays (``transform``, ``exists``, ``filter``) are evaluated
outside whole-stage code generation, the others inside it."""
