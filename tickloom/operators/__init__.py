"""The stages' operators: quotes, bars, features, fitting, splitting, labelling."""
