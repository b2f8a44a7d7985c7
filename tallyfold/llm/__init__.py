"""Operators that prepare text for language-model training; nothing else imports them."""
