"""The three ready reports, composed from the operators."""
