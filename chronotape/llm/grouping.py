"""A grouping genetic algorithm for bin packing: genes are whole bins, not items.

One :class:`Island` evolves packings of one bounded set of items. It knows nothing of Spark;
:mod:`chronotape.llm.packing` deals items into sets, runs islands and moves elites between them.
"""

from __future__ import annotations

import math

import numpy as np

Packing = list[list[int]]


class BestFit:
    """Open bins by free space: the fullest bin that still takes an item is found by one bit scan."""

    def __init__(self, lengths: list[int], capacity: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.bins: Packing = []
        self._with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._mask = 0

    def add_bin(self, items: list[int]) -> None:
        self._open(len(self.bins), self.capacity - sum(self.lengths[i] for i in items))
        self.bins.append(items)

    def _open(self, at: int, room: int) -> None:
        if room:
            self._with_room[room].append(at)
            self._mask |= 1 << room

    def place(self, item: int) -> None:
        length = self.lengths[item]
        fitting = self._mask >> length
        if not fitting:
            self._open(len(self.bins), self.capacity - length)
            self.bins.append([item])
            return
        room = length + (fitting & -fitting).bit_length() - 1
        held = self._with_room[room]
        at = held.pop()
        if not held:
            self._mask &= ~(1 << room)
        self.bins[at].append(item)
        self._open(at, room - length)


class Island:
    """A small population of packings of ``lengths`` (each 1..capacity) into bins of ``capacity``."""

    def __init__(self, lengths: list[int], capacity: int, seed: int, size: int = 4) -> None:
        self.lengths, self.capacity, self.size = lengths, capacity, size
        self.random = np.random.default_rng(seed)
        self.bound = math.ceil(sum(lengths) / capacity)
        self.population: list[Packing] = []

    def seed_population(self) -> None:
        """Best-fit decreasing first, then best-fit in noisy decreasing orders."""
        lengths = np.asarray(self.lengths)
        for k in range(self.size):
            noise = self.random.uniform(0, 40.0 * k, len(lengths)) if k else 0.0
            packer = BestFit(self.lengths, self.capacity)
            for item in np.argsort(-(lengths + noise), kind="stable").tolist():
                packer.place(item)
            self.population.append(packer.bins)
            if len(packer.bins) <= self.bound:
                break

    def fitness(self, packing: Packing) -> tuple[int, float]:
        """Fewer bins first, then fuller bins (the mean square of their fill); smaller is better."""
        fill = np.asarray([sum(self.lengths[i] for i in b) for b in packing]) / self.capacity
        return len(packing), -float(np.mean(fill * fill)) if packing else 0.0

    def best(self) -> Packing:
        return min(self.population, key=self.fitness)

    def welcome(self, elite: Packing) -> None:
        """A migrant replaces the worst packing when it is better."""
        worst = max(range(len(self.population)), key=lambda k: self.fitness(self.population[k]))
        if self.fitness(elite) < self.fitness(self.population[worst]):
            self.population[worst] = elite

    def evolve(self, generations: int) -> None:
        for _ in range(generations):
            if len(self.best()) <= self.bound or len(self.population) < 2:
                return
            order = sorted(self.population, key=self.fitness)
            one, two = sorted(self.random.choice(len(order), 2, replace=False).tolist())
            child = self.crossover(order[one], order[two])
            if self.fitness(child) < self.fitness(order[-1]):
                order[-1] = child
            self.population = order

    def crossover(self, receiver: Packing, donor: Packing) -> Packing:
        """Inject the donor's well-filled bins whole; receiver bins that share an item with them, and its
        emptiest bins, are dissolved, and what is thereby displaced is best-fitted, longest first."""
        fill = np.asarray([sum(self.lengths[i] for i in b) for b in donor])
        full = np.flatnonzero(fill >= np.quantile(fill, 0.5))
        start, share = int(self.random.integers(len(full))), max(1, len(full) // 8)
        injected = [donor[k] for k in np.take(full, range(start, start + share), mode="wrap").tolist()]
        if share >= len(full):
            injected = [donor[k] for k in full.tolist()]
        taken = {i for b in injected for i in b}
        emptiest = self.capacity * (1 - 0.5 / max(1, len(receiver)) ** 0.5)
        packer, displaced = BestFit(self.lengths, self.capacity), []
        for b in injected:
            packer.add_bin(list(b))
        for b in receiver:
            if taken.isdisjoint(b) and sum(self.lengths[i] for i in b) >= emptiest:
                packer.add_bin(list(b))
            else:
                displaced += [i for i in b if i not in taken]
        for item in sorted(displaced, key=lambda i: -self.lengths[i]):
            packer.place(item)
        return packer.bins
