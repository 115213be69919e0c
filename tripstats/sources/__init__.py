"""Messages, dimensions and the store of partials and totals."""
