"""Table builders of each layer and the run order between them."""
