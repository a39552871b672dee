"""Statloom: publication metadata of official statistics as DataFrame plans."""
