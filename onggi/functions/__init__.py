"""Column functions: text features, predicates, verifiers and templates. Built-in expressions unless a module says otherwise."""
