"""Models and relational building blocks, all as DataFrame plans."""
