"""DataFrame operators: grid shaping, column profile, type decision, cast, gate, audit."""
