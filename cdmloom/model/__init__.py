"""Table shapes and declarative specs."""
