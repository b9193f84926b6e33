"""DataFrame operators: layer transforms, checked dimension joins, quality checks, reports."""
